"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range and nothing else.  So sketches of parts merge to the
sketch of the whole, and the shares of two sketches estimate likeness and containment of texts of very unequal lengths.
A text of n distinct shingles has an empty sketch with the chance (1 - fraction) ** n; an empty sketch says nothing of its text, and is
like nothing else; only texts that are known to be equal are alike then.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.hashing import shingle_sets

K, FRACTION = 5, 1 / 4
PAIRED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, in_edited double, in_next double"


def sketch(hashes: np.ndarray, fraction: float = FRACTION) -> np.ndarray:
    """The sketch of a sorted array of distinct hashes."""
    return hashes if fraction >= 1 else hashes[: int(np.searchsorted(hashes, np.uint64(int(fraction * 2**64)), "left"))]


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two shingle sets whose sketches have one fraction."""
    return np.union1d(a, b)


def compare(a: np.ndarray, b: np.ndarray, equal: bool = False) -> tuple[float, float, float]:
    """Estimated Jaccard likeness, containment of a in b, of b in a.

    `equal` says that the texts are known to have the same shingles: then all are 1.  Otherwise an empty sketch, which says nothing, has 0 with any other, also an empty one.
    """
    if equal:
        return 1.0, 1.0, 1.0
    if not len(a) or not len(b):
        return 0.0, 0.0, 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both), both / len(a), both / len(b)


def encode(s: np.ndarray) -> str:
    import base64

    return base64.b64encode(s.astype("<u8").tobytes()).decode()


def decode(text: str) -> np.ndarray:
    import base64

    return np.frombuffer(base64.b64decode(text), "<u8")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, fraction: float = FRACTION) -> DataFrame:
    """Columns doc_id, fingerprint (base64 of little-endian hashes, ascending): one row per row of `docs`.

    Words are runs of non-blank characters with A-Z lowered; a text of fewer than k words is one shingle, and a
    null, empty or blank text has the empty fingerprint, as have a few very short ones.  Equal texts and repeated rows have equal
    fingerprints.  Very long texts are read whole; their fingerprints grow with them.  An empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [encode(sketch(s, fraction)) for s in shingle_sets(batch.column(1), k)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(run, "doc_id long, fingerprint string")


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns doc_id, text, block, tail: sorted within partitions so that each row's successor by id follows it.

    Ids are cut into blocks at quantiles.  The first document of a block is also sent, as its tail, to the block
    before (that of the first block to the last), so only one text per block travels twice.
    """
    spark = docs.sparkSession
    slim = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("key"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    blocks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    # One bound per block reaches the driver; a block begins at the smallest id that is not below its bound.
    cuts = slim.select(F.percentile_approx("key", [i / blocks for i in range(blocks)], max(10_000, 10 * blocks)).alias("at"), F.min("key").alias("low")).first()
    bounds = np.unique(np.array([cuts["low"], *(cuts["at"] or [])] if cuts["low"] is not None else [0], np.int64))

    @F.pandas_udf("array<struct<block:int,tail:boolean>>")
    def routes(key: pd.Series) -> pd.Series:
        key = key.to_numpy()
        block = np.searchsorted(bounds, key, "right") - 1
        first = bounds[block] == key  # the quantiles are values of the column, so every bound is the id of a block's first document
        return pd.Series([[{"block": int(b), "tail": False}] + ([{"block": int((b - 1) % len(bounds)), "tail": True}] if f else []) for b, f in zip(block, first, strict=True)])

    routed = slim.select("key", "doc_id", "text", F.explode(routes("key")).alias("to")).select("key", "doc_id", "text", "to.*")
    # Four blocks for each partition, one after the other, so that no task gets many by chance.
    return routed.repartitionById(max(1, -(-len(bounds) // 4)), F.floor(F.col("block") / 4).cast("int")).sortWithinPartitions("block", "tail", "key", "text")


def paired_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, fraction: float = FRACTION) -> DataFrame:
    """Fingerprints of each text, of its edited form, and their likeness, with the likeness to the next text.

    near_edited and near_next are likenesses, in_edited and in_next the shares of the text that the other contains.

    The edited text has its last half (rounded down, in code points) replaced by as many first code points of the
    next document by id, or all that it has; the last document's next is the first.  A null text is empty; null ids
    come first; rows of equal id follow in order of their text.  A lone document is its own next.  Equal texts have likeness 1; other texts have 0
    where one of the sketches is empty, as those of some texts of few shingles are.  Texts of any length are read whole.  An empty
    table gives no rows; other columns of any names are ignored.
    """
    spark_cols = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "in_edited", "in_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.float64()] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        last = None  # doc_id, text, its sketch, block
        done = None  # the block whose tail has come
        for batch in batches:
            for part in range(0, batch.num_rows, 512):
                rows = batch.slice(part, 512)
                ids, blocks, tails = (rows.column(c).to_pylist() for c in ("doc_id", "block", "tail"))
                texts = rows.column("text").to_pylist()
                own = [sketch(s, fraction) for s in shingle_sets(rows.column("text"), k)]
                out, edited, pairs = [], [], []
                for i in range(len(ids)):
                    if blocks[i] == done:
                        continue
                    if last is not None and last[3] == blocks[i]:
                        n = len(last[1])
                        new = last[1][: n - n // 2] + texts[i][: n // 2]
                        edited.append(new)
                        pairs.append((last[2], own[i], new == last[1], texts[i] == last[1]))
                        out.append((last[0], n, hashlib.sha256(new.encode()).hexdigest()))
                    if tails[i]:
                        done, last = blocks[i], None
                    else:
                        last = (ids[i], texts[i], own[i], blocks[i])
                if out:
                    new = [sketch(s, fraction) for s in shingle_sets(pa.array(edited, pa.string()), k)]
                    rest = [(encode(a), encode(e), *(compare(a, x, same)[i] for i in (0, 1) for x, same in ((e, as_edited), (b, as_next)))) for (a, b, as_edited, as_next), e in zip(pairs, new, strict=True)]
                    columns = zip(*((*x, *y) for x, y in zip(out, rest, strict=True)), strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], spark_cols)

    return with_next(docs, id_col, text_col).select("doc_id", "text", "block", "tail").mapInArrow(run, PAIRED)
