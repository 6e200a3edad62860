"""Reconciliation, freshness, schema drift, and maintenance of tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.operators.joins import null_safe_join
from aerolith.sinks.upsert import replace_partitions


def reconcile(source: DataFrame, serving: DataFrame, key: str, time: str, since: Column, tolerance: float = 0.95) -> DataFrame:
    """One row: distinct non-null keys on both sides since a time, their ratio (1 for an empty source), and whether it holds."""
    count = lambda df, name: df.where((F.col(time) >= since) & F.col(key).isNotNull()).agg(F.count_distinct(key).alias(name))
    both = count(source, "source_keys").join(F.broadcast(count(serving, "serving_keys")))  # one row each
    ratio = F.when(F.col("source_keys") == 0, 1.0).otherwise(F.try_divide(F.col("serving_keys"), F.col("source_keys")))
    return both.withColumn("ratio", ratio).withColumn("ok", F.col("ratio") + 1e-9 >= tolerance)


def freshness(df: DataFrame, time: str, now: Column, most_hours: float) -> DataFrame:
    """One row: hours since the newest row, and whether that is recent enough (an empty table is not)."""
    age = (F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.max(time).cast("timestamp"))) / 3600.0
    return df.agg(F.max(time).alias("newest"), age.alias("age_hours")).withColumn("ok", F.coalesce(F.col("age_hours") <= most_hours, F.lit(False)))


def null_ratio_check(df: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    """One row per column: its null ratio, its limit, and whether it holds, from one pass."""
    one = df.agg(*(F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)).alias(c) for c in limits))
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit(0.0)).alias("null_ratio"), F.lit(float(x)).alias("limit")) for c, x in limits.items()))
    return one.select(F.inline(pairs)).withColumn("ok", F.col("null_ratio") <= F.col("limit"))


def schema_hash(columns: Sequence[tuple[str, str]]) -> Column:
    """SHA-256 of the ordered names and types, to tell whether features still fit a model."""
    return F.sha2(F.lit(";".join(f"{c}:{t}" for c, t in columns)).cast("binary"), 256)


def cluster_report(df: DataFrame, cluster: str) -> DataFrame:
    """Rows per cluster and share of all; null is the missing cluster."""
    counts = df.groupBy(cluster).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))  # one row
    return counts.join(F.broadcast(total)).select(cluster, "n", (F.col("n") / F.col("total")).alias("share"))


def repeated_predictions(predictions: DataFrame, keys: Sequence[str] = ("model_name", "horizon_hours", "hour")) -> DataFrame:
    """Keys that several predictions have, with their number; there should be none."""
    return predictions.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def split_report(df: DataFrame, time: str, targets: Sequence[str]) -> DataFrame:
    """By split: rows, first and last time, and rows that have each target."""
    return df.groupBy("split").agg(F.count("*").alias("n"), F.min(time).alias("first"), F.max(time).alias("last"), *(F.count(c).alias(f"{c}_n") for c in targets))


def compact(spark: SparkSession, path: str, partition_by: Sequence[str] = (), target_mb: int = 256) -> dict:
    """Rewrite a Parquet table in files of about `target_mb`; gives files before and after.

    A partition has a task of its own, and one more for each `target_mb` beyond, so no task grows with the table.
    """
    df = spark.read.parquet(path)
    before = len(df.inputFiles())
    size = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path).agg(F.sum("length")).first()[0] or 0
    parts = max(1, round(size / (target_mb * 1e6)))
    dealt = df.repartition(parts)
    if partition_by:
        share = size / (target_mb * 1e6 * max(1, df.count()))
        lanes = df.groupBy(*partition_by).agg(F.greatest(F.ceil(F.count("*") * F.lit(share)), F.lit(1)).alias("__lanes"))  # one row a partition
        parts = int(lanes.agg(F.sum("__lanes")).first()[0] or 1)
        rows = null_safe_join(df, lanes, partition_by).withColumn("__lane", F.pmod(F.monotonically_increasing_id(), F.col("__lanes")))
        dealt = rows.repartition(parts, *partition_by, "__lane").select(*df.columns)
    replace_partitions(dealt, path, partition_by)
    return {"path": path, "files_before": before, "files_after": len(spark.read.parquet(path).inputFiles())}


def maintain(spark: SparkSession, catalog: str, tables: Sequence[str], retention_hours: int = 168) -> list[dict]:
    """Compaction, snapshot expiry and orphan removal by the table format's procedures, with a status for every call."""
    out = []
    limit = f"older_than => current_timestamp() - INTERVAL {int(retention_hours)} HOURS"
    for table in tables:
        for call in (f"rewrite_data_files(table => '{table}')", f"expire_snapshots(table => '{table}', {limit})", f"remove_orphan_files(table => '{table}', {limit})"):
            try:
                spark.sql(f"CALL {catalog}.system.{call}").collect()
                out.append({"table": table, "call": call, "ok": True, "error": None})
            except Exception as error:  # the report names every failure
                out.append({"table": table, "call": call, "ok": False, "error": str(error).splitlines()[0]})
    return out
