"""Paged sources: a data source that reads windows of numbered pages, in batch and as a stream.

A collector asks a service for one window of time after the other and gets each as pages 1, 2, ... of JSON; here the pages lie in files,
`<path>/window=<name>/page=<n>/<any>.json`, in any file system that Arrow opens.  Names of windows sort in order of time.  Batch reads
plan ranges of pages as partitions, so pages are fetched in parallel and never by the driver.  The stream's offset is the last window read: each trigger
plans the pages of the windows after it, and a window counts once all of it is there, as told by its `_SUCCESS` file.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from aerolith.operators.series import ranked
from aerolith.shared import staged

#: Columns that tell where a record comes from; a schema may name them.
WINDOW, PAGE = "window", "page"
DONE = "_SUCCESS"


@dataclass
class Pages(InputPartition):
    """Pages of a window, by their numbers from first to last: a task fetches them and lists no folder of the window again."""

    window: str
    first: int
    last: int
    numbers: tuple[int, ...]

    def __init__(self, window: str, numbers: Sequence[int] = ()):
        super().__init__((window, tuple(numbers)))
        self.window, self.numbers = window, tuple(numbers)
        self.first, self.last = (self.numbers[0], self.numbers[-1]) if self.numbers else (0, -1)


class PageStore:
    """Windows and pages in a file system, fetched with retries."""

    def __init__(self, path: str, attempts: int = 3, wait_s: float = 0.1):
        self.path, self.attempts, self.wait_s = path, attempts, wait_s

    def _opened(self) -> tuple[pafs.FileSystem, str]:
        files, root = pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", self.path))
        return files, root.rstrip("/")

    def _named(self, folder: str, key: str) -> list[str]:
        files, root = self._opened()
        found = files.get_file_info(pafs.FileSelector(f"{root}/{folder}".rstrip("/"), allow_not_found=True))
        return [f.base_name.removeprefix(f"{key}=") for f in found if f.base_name.startswith(f"{key}=")]

    def windows(self) -> list[str]:
        """The names of the windows that are complete, in order; each has a mark that says so."""
        files, root = self._opened()
        names = sorted(self._named("", WINDOW))
        marks = files.get_file_info([f"{root}/{WINDOW}={n}/{DONE}" for n in names]) if names else []
        return [n for n, f in zip(names, marks, strict=True) if f.type != pafs.FileType.NotFound]

    def pages(self, window: str) -> list[int]:
        return sorted(int(n) for n in self._named(f"{WINDOW}={window}", PAGE))

    def fetch(self, window: str, page: int) -> list[dict]:
        """The records of a page: a JSON array, or the array `results` of an object, or one object a line.  Failures are tried again."""
        for left in reversed(range(self.attempts)):
            try:
                files, root = self._opened()
                parts = sorted(f.path for f in files.get_file_info(pafs.FileSelector(f"{root}/{WINDOW}={window}/{PAGE}={page}")) if f.is_file and not f.base_name.startswith(("_", ".")))
                return [r for p in parts for r in _records(files.open_input_stream(p).readall().decode())]
            except OSError:
                if not left:
                    raise
                time.sleep(self.wait_s * (self.attempts - left))
        return []

    def put(self, window: str, page: int, name: str, records: Sequence[str]) -> None:
        """Put a page of JSON records in place, under a name that readers pass over until all of it is written; one that is there already stays."""
        files, root = self._opened()
        folder = f"{root}/{WINDOW}={window}/{PAGE}={page}"
        if files.get_file_info(f"{folder}/{name}").type == pafs.FileType.NotFound:
            files.create_dir(folder, recursive=True)
            hidden = f"{folder}/.{uuid.uuid4().hex}"
            with files.open_output_stream(hidden) as out:
                out.write(f'{{"results":[{",".join(records)}]}}\n'.encode())
            files.move(hidden, f"{folder}/{name}")


def _records(text: str) -> list[dict]:
    out = []
    for line in [text] if text.lstrip().startswith("[") else text.split("\n"):  # JSON may hold other line ends as they are
        if line.strip():
            got = json.loads(line)
            out += got if isinstance(got, list) else got["results"] if "results" in got else [got]
    return out


def page_ranges(store: PageStore, windows: Sequence[str], size: int) -> list[Pages]:
    """Partitions of at most `size` pages."""
    out = []
    for window in windows:
        pages = store.pages(window)
        out += [Pages(window, pages[i : i + size]) for i in range(0, len(pages), size)]
    return out


def _batches(store: PageStore, part: Pages, schema: StructType) -> Iterator[pa.RecordBatch]:
    """One Arrow batch a page; fields that a record lacks are null, values of a wrong kind are an error of the task."""
    shape = to_arrow_schema(schema)
    for page in part.numbers:
        rows = [r | {WINDOW: part.window, PAGE: page} for r in store.fetch(part.window, page)]
        yield pa.RecordBatch.from_pydict({f.name: pa.array([r.get(f.name) for r in rows], f.type) for f in shape}, schema=shape)


class PagedReader(DataSourceReader):
    def __init__(self, store: PageStore, schema: StructType, start: str | None, end: str | None, size: int):
        self.store, self.schema, self.start, self.end, self.size = store, schema, start, end, size
        self.tests: list[tuple[str, str]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons of the window's name choose windows before any page is fetched; all others stay with Spark."""
        kinds = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        for f in filters:
            if type(f) in kinds and f.attribute == (WINDOW,) and isinstance(f.value, str):
                self.tests.append((kinds[type(f)], f.value))
            else:
                yield f

    def windows(self) -> list[str]:
        holds = {"=": str.__eq__, ">": str.__gt__, ">=": str.__ge__, "<": str.__lt__, "<=": str.__le__}
        return [w for w in self.store.windows() if (self.start is None or w >= self.start) and (self.end is None or w < self.end) and all(holds[k](w, v) for k, v in self.tests)]

    def partitions(self) -> Sequence[InputPartition]:
        return page_ranges(self.store, self.windows(), self.size) or [Pages("")]

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        if partition.last >= 0:
            yield from _batches(self.store, partition, self.schema)


class PagedStreamReader(DataSourceStreamReader):
    """Offsets are the name of the last window read."""

    def __init__(self, store: PageStore, schema: StructType, start: str | None, size: int):
        self.store, self.schema, self.first, self.size = store, schema, start, size

    def initialOffset(self) -> dict:
        """Before the first window that counts: a name sorts after every name that is a part of it or smaller."""
        return {WINDOW: "" if self.first is None else max((w for w in self.store.windows() if w < self.first), default="")}

    def latestOffset(self) -> dict:
        return {WINDOW: max(self.store.windows(), default=self.initialOffset()[WINDOW])}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return page_ranges(self.store, [w for w in self.store.windows() if start[WINDOW] < w <= end[WINDOW]], self.size)

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        return _batches(self.store, partition, self.schema)


class PagedSource(DataSource):
    """`spark.read.format("pages").schema(...)` with the options path, start and end (windows), pages_per_task and attempts."""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def _store(self) -> PageStore:
        return PageStore(self.options["path"], int(self.options.get("attempts", 3)))

    def _size(self) -> int:
        return max(1, int(self.options.get("pages_per_task", 16)))

    def reader(self, schema: StructType) -> PagedReader:
        return PagedReader(self._store(), schema, self.options.get("start"), self.options.get("end"), self._size())

    def streamReader(self, schema: StructType) -> PagedStreamReader:
        return PagedStreamReader(self._store(), schema, self.options.get("start"), self._size())


def write_pages(rows: DataFrame, path: str, window: str, order: Sequence[str], size: int) -> None:
    """Write rows as pages of at most `size` records, as a collector of those windows would: `window` names each row's (text), `order` puts rows in order within it.

    Pages are numbered from 1 in each window.  Each page is a folder with one line of JSON, {"results": [...]}; the marks of the windows come last.  Tasks put
    their pages in place through Arrow's file systems, one page in memory at a time; a page shows once it is whole, so a task that is tried again changes none.
    """
    spark = rows.sparkSession
    numbered = ranked(rows, [window, *order], "__rank", "__total")
    firsts = staged(numbered.groupBy(window).agg(F.min("__rank").alias("__first")), "windows")  # one row a window
    paged = numbered.join(firsts, window).withColumn("__page", F.floor((F.col("__rank") - F.col("__first")) / size).cast("int") + 1)
    record = F.to_json(F.struct(*(c for c in rows.columns if c != window)))
    store, name = PageStore(path), f"part-{uuid.uuid4().hex}.json"

    def put(key: tuple[pa.Scalar, ...], page: pa.Table) -> pa.Table:
        names = [k.as_py() for k in key]
        store.put(*names, name, page.sort_by("rank")["record"].to_pylist())
        return pa.table({WINDOW: [names[0]], PAGE: pa.array([names[1]], pa.int32())})

    pages = paged.select(F.col(window).alias(WINDOW), F.col("__page").alias(PAGE), F.col("__rank").alias("rank"), record.alias("record")).groupBy(WINDOW, PAGE)
    pages.applyInArrow(put, f"{WINDOW} string, {PAGE} int").count()  # at most `size` records a page
    for row in firsts.select(window).toLocalIterator():
        mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{WINDOW}={row[0]}/{DONE}")
        mark.getFileSystem(spark._jsc.hadoopConfiguration()).create(mark, True).close()


def register_pages(spark: SparkSession) -> None:
    """Make the format `pages` known; filters on windows reach it while the session allows them to."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedSource)
