"""Streams of JSON events: parse, type, append or upsert, windows, progress."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from aerolith.operators.dedup import latest_per_key, newest
from aerolith.sinks.upsert import upsert

#: Default intervals of the streams.
INTERVALS = {"weather": "30 seconds", "sensor": "30 seconds", "swath": "45 seconds", "granule": "60 seconds", "reanalysis": "30 seconds"}


def kafka_source(spark: SparkSession, servers: str, topic: str, starting: str = "latest", max_offsets: int | None = None) -> DataFrame:
    """The topic's records as key and value text; needs Spark's Kafka package on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", starting).option("failOnDataLoss", "false")
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"))


def file_source(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Lines of text files as the column value: the same contract as a topic."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)


def parsed(events: DataFrame, schema: StructType | str, time: Column | Sequence[str], drop_malformed: bool = False) -> DataFrame:
    """Typed columns of JSON values, with event_time and its date parts.

    Malformed JSON gives a row of nulls, unless it is to be dropped.  `time` is a column or the names of text columns
    of which the first that parses counts.
    """
    rows = events.select(F.from_json("value", schema).alias("data"), "value")
    if drop_malformed:
        rows = rows.where(F.col("data").isNotNull() & F.get_json_object("value", "$").isNotNull())
    rows = rows.select("data.*")
    stamp = time if isinstance(time, Column) else F.coalesce(*(F.try_to_timestamp(c) for c in time))
    rows = rows.withColumn("event_time", stamp)
    return rows.select("*", *(f("event_time").alias(n) for n, f in (("year", F.year), ("month", F.month), ("day", F.dayofmonth), ("hour", F.hour))))


def flattened(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """A struct's fields as columns of their own."""
    return df.select("*", *(F.col(f"{column}.{n}").alias(f"{column}_{n}") for n in names)).drop(column)


def triggered(writer: DataStreamWriter, once: bool, interval: str) -> DataStreamWriter:
    """All that is there and then an end, or batches at an interval."""
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)


def append_to(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (), once: bool = True, interval: str = "30 seconds", files: int | None = None) -> StreamingQuery:
    """Append each batch to the table; with `files`, its partitions are read by so many tasks at most, and each task writes one file (a value of `partition_by`)."""
    writer = (df.coalesce(files) if files else df).writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return triggered(writer.partitionBy(*partition_by) if partition_by else writer, once, interval).start()


def upsert_to(df: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], partition_by: Sequence[str] = (), once: bool = True, interval: str = "30 seconds") -> StreamingQuery:
    """Every batch's latest row per key replaces the table's; null keys are dropped, and a repeated batch changes nothing."""

    def write(batch: DataFrame, _: int) -> None:
        rows = batch
        for k in keys:
            rows = rows.where(F.col(k).isNotNull())
        if not rows.isEmpty():
            upsert(latest_per_key(rows, list(keys), newest(*order)), path, keys, partition_by)

    return triggered(df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), once, interval).start()


def deduplicated(df: DataFrame, keys: Sequence[str], time: str, late: str) -> DataFrame:
    """The first event of each key within the lateness; state is dropped behind the watermark."""
    return df.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def windowed(df: DataFrame, time: str, late: str, length: str, aggregates: Sequence[Column], by: Sequence[str] = (), slide: str | None = None) -> DataFrame:
    """Tumbling or sliding windows, closed by the watermark."""
    w = F.window(time, length, slide) if slide else F.window(time, length)
    out = df.withWatermark(time, late).groupBy(w, *by).agg(*aggregates)
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *[c for c in out.columns if c != "window"])


def sessions(df: DataFrame, time: str, late: str, gap: str, aggregates: Sequence[Column], by: Sequence[str]) -> DataFrame:
    out = df.withWatermark(time, late).groupBy(F.session_window(time, gap), *by).agg(*aggregates)
    return out.select(F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), *[c for c in out.columns if c != "session_window"])


def progress(query: StreamingQuery) -> list[dict]:
    """Rows, rate and offsets of the query's recent batches."""
    return [{"batch": p["batchId"], "rows": p["numInputRows"], "rows_per_second": p.get("inputRowsPerSecond", 0.0), "end": [s["endOffset"] for s in p["sources"]]} for p in (q if isinstance(q, dict) else json.loads(q.json) for q in query.recentProgress)]


def lag_of(latest: dict[str, int], committed: dict[str, int], most: int = 50_000) -> tuple[int, bool]:
    """Records behind over all partitions, and whether that is tolerable; no committed offset yet is tolerable."""
    behind = sum(max(0, end - committed.get(p, end)) for p, end in latest.items())
    return behind, not committed or behind <= most


def lag_rows(latest: DataFrame, committed: DataFrame, by: Sequence[str] = ("topic",), most: int = 50_000) -> DataFrame:
    """By topic the records behind over all partitions (columns partition and offset on both sides), and whether that is tolerable, by the rules of :func:`lag_of`."""
    keys = [*by, "partition"]
    both = latest.join(committed.select(*keys, F.col("offset").alias("__done")), keys, "left")
    behind = F.sum(F.greatest(F.lit(0), F.col("offset") - F.coalesce("__done", "offset")))
    out = both.groupBy(*by).agg(behind.alias("behind"), F.count("__done").alias("__known"))
    return out.select(*by, "behind", ((F.col("__known") == 0) | (F.col("behind") <= most)).alias("ok"))
