"""Streaming upserts with keyed state: the latest row of each key, and only what changes goes on.

A sink that merges each micro-batch into a table has to read the table to know what is newer.  Here the state knows: it holds the order of the latest row of each key, so
that a batch sends a key's row only if it is newer than all before it, and the sink gets changes alone.  A timer drops a key's state once the watermark has
passed its latest row by `keep`; rows behind the watermark are dropped before.

Where the event time is itself a part of the key (the start of an hour, say), a key's rows and its state fall behind the watermark together, so no timer is needed and
Spark's own aggregation keeps the state, without a call of Python for each key.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from aerolith.sinks.upsert import upsert
from aerolith.streaming.pipelines import triggered

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """State of this kind needs the store that keeps it on disk."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


class LatestRow(StatefulProcessor):
    """Keeps the order of a key's latest row (a number and the columns that break ties), and gives that row where a batch has a newer one."""

    def __init__(self, schema: StructType, order: Sequence[str], keep_ms: int):
        self.schema, self.order, self.keep_ms = schema, list(order), keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        kinds = {f.name: f for f in self.schema}
        self.handle = handle
        self.latest = handle.getValueState("latest", StructType([StructField("__ms", LongType()), *(kinds[c] for c in self.order)]))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        rank = lambda row: tuple((row[c] is not None, row[c]) for c in self.order)
        best = max(rows, key=rank)
        held = self.latest.get() if self.latest.exists() else None
        if held is not None:
            before = tuple((v is not None, v) for v in tuple(held)[1:])
            if rank(best) <= before:
                return
            self.handle.deleteTimer(held[0])
        due = best["__ms"] + self.keep_ms
        self.latest.update((due, *(best[c] for c in self.order)))
        self.handle.registerTimer(due)
        yield Row(**{f.name: best[f.name] for f in self.schema})

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        self.latest.clear()
        return iter(())

    def close(self) -> None:
        pass


def latest_changes(stream: DataFrame, keys: Sequence[str], time: str, order: Sequence[str], late: str, keep_ms: int = 0) -> DataFrame:
    """Columns of `stream`: the rows that are newer than all rows of their key before them, at most one a key and batch.

    `time` is the event time (TIMESTAMP) of the watermark, `order` the columns whose greatest values make the latest row (nulls are smallest), the time first as a rule.  Rows with a null key or time
    are dropped.  A row that comes after its key's state was dropped counts as new, so `late` and `keep_ms` must cover how late rows of a key come.  An equal row changes nothing.

    If `time` is one of the keys, all rows of a key have one event time: state and late rows are dropped at `late` alone, `keep_ms` adds nothing, and the state holds the whole latest row.
    """
    rows = stream.where(F.col(time).isNotNull())
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    if time in keys:
        return _latest_by_aggregation(rows, keys, time, order, late)
    # Times cross to Python as microseconds, whatever its zone; one more copy carries the watermark.
    clocks = {f.name for f in stream.schema if isinstance(f.dataType, TimestampType)}
    rows = rows.select(*(F.unix_micros(c).alias(c) if c in clocks else c for c in stream.columns), F.unix_millis(time).alias("__ms"), F.col(time).alias("__time")).withWatermark("__time", late)
    shape = StructType([StructField(f.name, LongType() if f.name in clocks else f.dataType) for f in stream.schema])
    out = rows.groupBy(*keys).transformWithState(LatestRow(shape, order, keep_ms), shape, "Update", "EventTime")
    return out.select(*(F.timestamp_micros(c).alias(c) if c in clocks else c for c in stream.columns))


def _latest_by_aggregation(rows: DataFrame, keys: Sequence[str], time: str, order: Sequence[str], late: str) -> DataFrame:
    """The changes of keys that hold their event time: each row bears the time of its batch, and a key is sent if that of its latest row is this batch's."""
    batch = F.current_timestamp()  # one value for a batch, the same if the batch is repeated
    latest = F.struct(*(c for c in rows.columns if c not in keys), F.col("__batch"))
    # Of rows that are equal in order, the one of the earlier batch stays.
    rank = F.struct(*order, -F.unix_micros("__batch"))
    kept = rows.withColumn("__batch", batch).withWatermark(time, late).groupBy(*keys).agg(F.max_by(latest, rank).alias("__latest"))
    return kept.where(F.col("__latest.__batch") == batch).select(*(c if c in keys else F.col(f"__latest.{c}").alias(c) for c in rows.columns))


def upsert_changes(changes: DataFrame, path: str, checkpoint: str, keys: Sequence[str], partition_by: Sequence[str] = (), once: bool = True, interval: str = "30 seconds") -> StreamingQuery:
    """Merge the changes of each batch into the table at `path`; they have a row a key at most, and a repeated batch changes nothing."""

    def write(batch: DataFrame, _: int) -> None:
        upsert(batch, path, keys, partition_by)

    return triggered(changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint), once, interval).start()


def state_rows(query: StreamingQuery) -> list[tuple[int, int]]:
    """By batch: keys in state, and keys whose state was dropped."""
    return [(sum(s["numRowsTotal"] for s in p["stateOperators"]), sum(s["numRowsRemoved"] for s in p["stateOperators"])) for p in query.recentProgress]
