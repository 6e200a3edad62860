"""Best-fit packing by patterns of few lengths, fitted with non-negative least squares.

Spark tokenizes and counts; the histogram of piece lengths (one bin per length up to the capacity)
is all that the planner sees, so its work does not grow with the number of documents.  The plan says
which ranks of a length go to which sequences, and Spark looks every piece up in it.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm.common import checkpointed

#: Appended to every document.
END_ID = 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, bucket int, rank long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


@lru_cache(maxsize=2)
def load_encoding(name: str):
    """A byte-level BPE of the public vocabulary files by name, or by path where the name holds a slash."""
    import base64

    import public_tokenizers
    import tiktoken

    path = name if "/" in name else public_tokenizers.path(name)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("documents", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def load_tokenizer(name: str):
    """The same vocabulary in the other library's form, and the strings that it takes for tokens of their own."""
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file((name if "/" in name else public_tokenizers.path(name)).removesuffix(".tiktoken") + ".json")
    return tokenizer, [t.content for t in tokenizer.get_added_tokens_decoder().values()]


def token_ids(text: str, name: str) -> list[int]:
    """Ids of a text as the other library gives them.  The faster one does not know added tokens, nor can its pattern take very long runs of white space."""
    tokenizer, added = load_tokenizer(name)
    if not any(t in text for t in added):
        try:
            return load_encoding(name).encode_ordinary(text)
        except BaseException as error:
            if type(error).__name__ != "PanicException":
                raise
    return tokenizer.encode(text, add_special_tokens=False).ids


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: all but the first are full."""
    first = (length - 1) % capacity + 1
    return [(0, first), *((at, capacity) for at in range(first, length, capacity))]


def tokenized(docs: DataFrame, capacity: int, vocabulary: str, id_col: str, text_col: str, keep_ids: bool) -> DataFrame:
    """Pieces with their length, crc32, and rank among the pieces of that length in the same task."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        from pyspark import TaskContext

        bucket = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            rows, kept = [], []
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = [*token_ids(text.as_py() or "", vocabulary), END_ID]
                raw = memoryview(array("I", ids)).cast("B")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    rows.append((doc.as_py(), k, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)]), bucket, seen[length]))
                    seen[length] += 1
                    if keep_ids:
                        kept.append(ids[start : start + length])
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "bucket", "rank"]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            if keep_ids:
                arrays, names = [*arrays, pa.array(kept, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(pieces, PIECES + ", ids array<int>" * keep_ids)


def patterns(capacity: int, grid: int) -> np.ndarray:
    """Pairs and triples of lengths that fill a sequence; one length of a triple lies on a grid.  Rows hold 0 for no length."""
    pairs = [(a, capacity - a, 0) for a in range(1, capacity // 2 + 1)]
    step = max(1, capacity // grid)
    triples = {tuple(sorted((a, b, capacity - a - b))) for a in range(1, capacity // 2) for b in range(step, capacity, step) if capacity - a - b > 0}
    return np.array(pairs + sorted(triples), np.int64).reshape(-1, 3)


def fit(table: np.ndarray, wanted: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative repeat counts x that minimise |A x - wanted|^2, A[l, p] = times that pattern p holds length l.

    Accelerated projected gradient with restarts; the step is the inverse of a bound of the largest eigenvalue.
    """
    size = len(wanted)

    def cover(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(table[:, j], x, size) * (np.arange(size) > 0) for j in range(table.shape[1]))

    degree = cover(np.ones(len(table)))
    bound = max(1.0, float((degree[table] * (table > 0)).sum(1).max()))
    x = y = np.zeros(len(table))
    t = 1.0
    for _ in range(rounds):
        gap = cover(y) - wanted
        gap[0] = 0
        slope = gap[table].sum(1)
        new = np.maximum(0, y - slope / bound)
        if (slope * (new - x)).sum() > 0:
            t = 1.0
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / nt * (new - x), new, nt
    return x


def plan(counts: dict[int, int], capacity: int, grid: int = 64) -> list[tuple[int, int, int, int, int, int, int]]:
    """Rows (length, first rank, ranks, first sequence, offset, per sequence, sequences).

    Ranks [first, first + ranks) of a length go, `per sequence` at a time, to consecutive sequences from
    `offset` on.  Fitted patterns are rounded down to whole repeats that the histogram can fill; what remains
    is packed by best fit, the longest first, in runs of equal sequences.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    used = np.zeros(capacity + 1, np.int64)
    rows: list[tuple[int, int, int, int, int, int, int]] = []
    runs: list[tuple[int, list[tuple[int, int]]]] = []  # repeats, then (length, copies)

    def take(length: int, n: int) -> int:
        at = int(used[length])
        used[length] += n
        left[length] -= n
        return at

    if left.sum() > 0:
        table = patterns(capacity, grid)
        table = table[(left[table] * (table > 0) + (table == 0) > 0).all(1)]
        if len(table):
            wanted = left.astype(float)
            wanted[capacity] = 0
            repeats = fit(table, wanted)
            for p in np.argsort(-repeats, kind="stable"):
                if repeats[p] < 0.5:
                    break
                lengths = [int(v) for v in table[p] if v]
                copies = {v: lengths.count(v) for v in lengths}
                n = min([int(repeats[p]), *(int(left[v]) // c for v, c in copies.items())])
                if n > 0:
                    runs.append((n, sorted(copies.items(), reverse=True)))
                    for v, c in copies.items():
                        left[v] -= n * c
    # Best fit decreasing over the rest: open[r] lists runs (repeats, contents) of sequences with r free tokens.
    open_runs: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {0: []}
    free: list[int] = []
    for length in range(capacity, 0, -1):
        n = int(left[length])
        waiting = sorted(r for r in free if r >= length)
        heapq.heapify(waiting)
        while n:
            while waiting and not open_runs.get(waiting[0]):
                heapq.heappop(waiting)
            room, (repeats, held) = (waiting[0], open_runs[waiting[0]].pop()) if waiting else (capacity, (n, []))
            per = min(room // length, n)
            whole = min(repeats, n // per)
            if repeats > whole and held:
                open_runs[room].append((repeats - whole, held))
            rest = room - per * length
            open_runs.setdefault(rest, []).append((whole, [*held, (length, per)]))
            if rest not in free:
                heapq.heappush(free, rest)
            if rest >= length:
                heapq.heappush(waiting, rest)
            n -= per * whole
        left[length] = 0
    runs += [run for held in open_runs.values() for run in held]
    sequence = 0
    for repeats, held in runs:
        offset = 0
        for length, per in held:
            rows.append((length, take(length, per * repeats), per * repeats, sequence, offset, per, repeats))
            offset += length * per
        sequence += repeats
    return rows


def pack_documents(docs: DataFrame, capacity: int = 2048, vocabulary: str = "byte_bpe_50k.tiktoken", id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if kept).

    A null or empty text is a document of the end id alone.  Repeated rows are packed each; the id is carried and
    may be null; other columns are ignored.  An empty table gives no rows.  Token ids follow the byte-level BPE
    `vocabulary`; strings of its added tokens are those tokens.  Very long texts are cut into full pieces after a shorter first one.  Of
    pieces of one length, which are ties, those of earlier tasks and rows come first.
    """
    spark = docs.sparkSession
    pieces = checkpointed(tokenized(docs, capacity, vocabulary, id_col, text_col, keep_ids))
    # Ranks are counted by task and length, so a length that a third of all pieces share is no single group.
    counts = pieces.groupBy("bucket", "length").agg(F.count("*").alias("n"))
    before = counts.select("bucket", "length", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps = np.array(sorted(plan(histogram, capacity)), np.int64).reshape(-1, 7)
    shared = spark.sparkContext.broadcast(steps)  # bounded by the capacity, not by the documents

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps = shared.value
        width = np.int64(1) << np.int64(40)  # ranks of one length stay below
        keys = steps[:, 0] * width + steps[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            found = steps[np.searchsorted(keys, length * width + rank, "right") - 1]
            at = rank - found[:, 1]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            columns = [batch.column(c) for c in names[:5]]
            columns += [pa.array(found[:, 3] + at // found[:, 5]), pa.array(found[:, 4] + at % found[:, 5] * length)]
            if keep_ids:
                names, columns = [*names, "ids"], [*columns, batch.column("ids")]
            yield pa.RecordBatch.from_arrays(columns, names)

    ranked = pieces.join(before, ["bucket", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    return ranked.mapInArrow(look_up, PACKED + ", ids array<int>" * keep_ids)
