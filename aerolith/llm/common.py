"""Shared helpers: shared-folder checkpoints and distributed sums of dense arrays."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Entries of a dense array that travel in one row of :func:`sum_arrays`.
CHUNK = 1 << 16
#: Partitions that are summed in one group, and levels of the tree of sums.
FAN, LEVELS = 64, 3


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; own only in local mode when it is unset."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            path = tempfile.mkdtemp(prefix="aerolith-checkpoint-")
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of a slim table in the shared folder, so that a lost executor costs no recomputation."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """`df` as a Parquet table in the shared folder: cuts the lineage as a checkpoint does, in fewer bytes for wide runs of equal values."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_row(df: DataFrame, *but: str) -> Column:
    """All columns but some in one struct, so that names used inside an operator cannot clash with theirs."""
    return F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in df.columns if c not in but))


def without_keys(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of `docs`, all columns, whose id and text hash do not stand in `gone` (d, t)."""
    rows = docs.select(whole_row(docs).alias("row"), F.col(id_col).cast("long").alias("doc"), F.xxhash64(F.col(text_col)).alias("hash"))
    left = rows.join(gone.select("d", "t").hint("shuffle_hash"), F.col("doc").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("t")), "left_anti")
    return left.select("row.*")


def held_out(id_col: Column) -> Column:
    """True where crc32 of the id as text leaves no remainder by 5 (a null id counts as the text '')."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _packed(part: np.ndarray) -> tuple[str, bytes]:
    """Type and compressed bytes of counts, in the narrowest type that holds them."""
    import zlib

    kind = "<i8" if part.max() > 0x7FFFFFFF or part.min() < 0 else "<u1" if part.max() < 0x100 else "<u2" if part.max() < 0x10000 else "<i4"
    return kind, zlib.compress(part.astype(kind).tobytes(), 1)


def sum_arrays(df: DataFrame, partial: Callable[[Iterator[pd.DataFrame]], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """Sum fixed-size arrays of counts that `partial` makes of each partition.

    The arrays have a size that does not depend on the data.  Every partition sends them as compressed chunks, which
    are added in a tree: a group holds the chunks of at most FAN partitions, and only the sums reach the driver.
    """
    import zlib

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        lane, rows = TaskContext.get().partitionId(), []
        for name, array in partial(batches).items():
            for at in range(0, len(array), CHUNK):
                part = np.ascontiguousarray(array[at : at + CHUNK], dtype="<i8")
                if part.any():
                    rows.append((name, at, lane, len(array), *_packed(part)))
        yield pd.DataFrame(rows, columns=["name", "at", "lane", "size", "kind", "data"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = 0
        for kind, data in zip(pdf["kind"], pdf["data"], strict=True):
            total = total + np.frombuffer(zlib.decompress(data), kind).astype("<i8")
        kind, data = _packed(total)
        return pd.DataFrame({**{c: [pdf[c][0]] for c in ("name", "at", "lane", "size")}, "kind": [kind], "data": [data]})

    shape = "name string, at long, lane long, size long, kind string, data binary"
    parts = df.mapInPandas(split, shape)
    for _ in range(LEVELS):
        parts = parts.withColumn("lane", F.floor(F.col("lane") / FAN)).groupBy("name", "at", "lane").applyInPandas(add, shape)
    out: dict[str, np.ndarray] = {}
    for r in parts.collect():
        array = out.setdefault(r["name"], np.zeros(r["size"], np.int64))
        part = np.frombuffer(zlib.decompress(r["data"]), r["kind"])
        array[r["at"] : r["at"] + len(part)] += part
    return out
