"""Sharding: contiguous byte-balanced shards from global prefix sums.

Rows are put in one global order, every partition reports its total, and the prefix of those
totals gives each row its place in the whole table without a single-task window.  Shards are cut
at equal byte targets, and a row goes where its middle lies.  The order is by text hash, so a shard is contiguous in that order; it keeps equal texts next to each
other, so of all groups of equal texts a cut can part one alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import checkpointed

PLACED = "doc_id long, size long, text_crc32 long, h long, start long, row long"


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, size, text_crc32, shard, slot: one row per row of `docs`.

    size is the UTF-8 bytes of the text plus 1; a null text has none, so its size is 1 and its crc32
    that of no bytes.  Repeated rows and null ids are rows like any other.  The order is by text hash, size, crc32 and id; rows
    that tie in all of these are equal.  Shards differ by the size of a row at most, so a very long text can leave one short.  An
    empty table gives an empty result; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
    )
    order = ["h", "size", "text_crc32", "doc_id"]
    # Slim rows alone are kept and sorted; texts are read once and never shuffled.
    slim = checkpointed(slim)
    ordered = checkpointed(slim.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()))
    # One row per partition reaches the driver.
    totals = sorted(ordered.groupBy("part").agg(F.sum("size").alias("size"), F.count("*").alias("rows")).collect(), key=lambda r: r["part"])
    before, bytes_so_far, rows_so_far = {}, 0, 0
    for r in totals:
        before[r["part"]] = (bytes_so_far, rows_so_far)
        bytes_so_far, rows_so_far = bytes_so_far + r["size"], rows_so_far + r["rows"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = row = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if start is None:
                start, row = before[batch.column("part")[0].as_py()]
            size = batch.column("size").to_numpy(zero_copy_only=False)
            ends = start + np.cumsum(size)
            columns = [batch.column(c) for c in ("doc_id", "size", "text_crc32", "h")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ends - size), pa.array(np.arange(row, row + len(size)))], ["doc_id", "size", "text_crc32", "h", "start", "row"])
            start, row = int(ends[-1]), row + len(size)

    placed = checkpointed(ordered.mapInArrow(place, PLACED))
    total = max(bytes_so_far, 1)
    shard = sum((F.when(2 * F.col("start") + F.col("size") >= 2 * total * k // shards, 1).otherwise(0) for k in range(1, shards)), F.lit(0)).cast("int")
    firsts = {r["shard"]: r["first"] for r in placed.groupBy(shard.alias("shard")).agg(F.min("row").alias("first")).collect()}
    first = F.coalesce(*(F.when(shard == k, F.lit(v)) for k, v in firsts.items()), F.lit(0))
    return placed.select("doc_id", "size", "text_crc32", shard.alias("shard"), (F.col("row") - first).cast("long").alias("slot"))

