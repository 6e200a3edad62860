"""Serving rows, exports, and Kafka."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.operators.dedup import latest_per_key, newest
from aerolith.operators.series import ranked

#: Keys of the serving tables, the partition's part first.
WEATHER_KEY = ["province", "day", "event_time"]
SENSOR_KEY = ["city", "parameter", "day", "event_time"]
WEATHER_COLUMNS = "event_id province query_date day event_time time_epoch location_name lat lon temp_c temp_f humidity wind_kph wind_degree wind_dir precip_mm condition_text source ingest_time".split()
SENSOR_COLUMNS = "event_id city parameter day event_time location_id location_name provider sensor_id unit value min max sd coverage_pct source ingest_time".split()


def last_write_wins(df: DataFrame, key: Sequence[str], written: str = "ingest_time", tie: str = "event_id") -> DataFrame:
    """One row per serving key, the last written; rows with a null in the key cannot be served."""
    whole = df.where(F.concat(*(F.col(k).cast("string") for k in key)).isNotNull())
    return latest_per_key(whole, list(key), newest(written, tie))


def key_collisions(df: DataFrame, key: Sequence[str], source: Sequence[str]) -> DataFrame:
    """Keys under which several sources meet, with their number: what serving overwrites."""
    return df.groupBy(*key).agg(F.count_distinct(F.struct(*source)).alias("sources")).where("sources > 1")


def weather_rows(df: DataFrame) -> DataFrame:
    time = F.coalesce(F.col("event_time").cast("timestamp"), F.try_to_timestamp("time", F.lit("yyyy-MM-dd HH:mm")))
    rows = df.withColumn("query_date", F.col("query_date").cast("date")).withColumn("event_time", time).withColumn("day", F.date_format("query_date", "yyyy-MM-dd")).withColumn("ingest_time", F.col("ingest_time").cast("string"))
    return last_write_wins(rows.select(*WEATHER_COLUMNS), WEATHER_KEY)


def sensor_rows(df: DataFrame) -> DataFrame:
    time = F.coalesce(F.col("event_time").cast("timestamp"), F.try_to_timestamp("datetime_utc"))
    rows = df.withColumn("event_time", time).withColumn("day", F.date_format("event_time", "yyyy-MM-dd")).withColumn("ingest_time", F.col("ingest_time").cast("string"))
    return last_write_wins(rows.select(*SENSOR_COLUMNS), SENSOR_KEY)


def features(df: DataFrame, lat: str, lon: str, properties: Sequence[str]) -> DataFrame:
    """One GeoJSON feature per row, as text in the column `value`: lines of a collection that text sinks write in parallel."""
    shape = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"), F.struct(*properties).alias("properties"))
    return df.select(F.to_json(shape).alias("value"))


def paths_as_lines(df: DataFrame, traj: str, order: str, lat: str, lon: str) -> DataFrame:
    """One GeoJSON line string per trajectory, its points in order."""
    points = F.transform(F.array_sort(F.collect_list(F.struct(order, lon, lat))), lambda p: F.array(p[lon], p[lat]))
    shape = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("LineString").alias("type"), F.col("points").alias("coordinates")).alias("geometry"), F.struct(traj).alias("properties"))
    return df.groupBy(traj).agg(points.alias("points")).select(traj, F.to_json(shape).alias("value"))


def kafka_rows(df: DataFrame, key: str | Column = "event_id") -> DataFrame:
    """Key and JSON value of each row, as `write.format("kafka")` takes them."""
    return df.select((F.col(key) if isinstance(key, str) else key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def publish(df: DataFrame, kind: str = "kafka", key: str | Column = "event_id", mode: str = "append", **options: str) -> None:
    """Write each row as key and JSON value by a connector (for Kafka the options are kafka.bootstrap.servers and topic); rows without a key are an error."""
    rows = kafka_rows(df, key)
    checked = rows.select(F.when(F.col("key").isNull(), F.raise_error(F.lit("a row without a key cannot be published"))).otherwise(F.col("key")).alias("key"), "value")
    checked.write.format(kind).options(**options).mode(mode).save()


def collection(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """Write features (column value and `order`) as one GeoJSON collection: text files that, one after the other by name, are its JSON.

    Lines are numbered in order over all tasks, so commas stand between features and the frame at both ends, and no task holds more than its range.
    """
    rows = ranked(df.select(*order, "value"), list(order))
    comma = F.when(F.col("rank") < F.col("total"), F.lit(",")).otherwise(F.lit("]}"))
    start = F.when(F.col("rank") == 1, F.lit('{"type":"FeatureCollection","features":[')).otherwise(F.lit(""))
    lines = rows.select("rank", F.concat(start, F.col("value"), comma).alias("value"))
    lines.repartitionByRange("rank").sortWithinPartitions("rank").select("value").write.mode("overwrite").text(path)


def csv_export(df: DataFrame, path: str, time_columns: Sequence[str] = ()) -> None:
    """CSV with a header, quotes doubled within quotes, and ISO times; nulls are empty fields."""
    iso = {c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") for c in time_columns}
    df.withColumns(iso).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", '""').option("nullValue", "").csv(path)
