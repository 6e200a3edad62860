"""Jobs: python -m aerolith.jobs NAME --tables FOLDER [--start-date D] [--end-date D] [--full-refresh 1] [--events FOLDER | --servers S --topic T].

Every batch job reads its sources below FOLDER by registry name, builds its table for the given days, and merges it by
the registry's keys; a full refresh replaces the rows within the built range.  Bronze tables of events are built by streams, which read JSON lines of a
folder or a topic, end with what is there unless told to go on, and resume where they were.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from aerolith.config import Settings, truthy
from aerolith.functions import iso_time
from aerolith.ml.cluster import cluster_points, clusters
from aerolith.operators.joins import covered_runs, forward_starts, planned_runs
from aerolith.operators.quality import bbox_filter, date_range, finite, threshold_hours
from aerolith.operators.stats import pivot_max
from aerolith.operators.trajectory import anchors, by_init_window, hourly_features, parse_dump, path_features
from aerolith.plans import gold, silver
from aerolith.plans.registry import TABLES
from aerolith.sinks.upsert import full_refresh, read_or_none, replace_table, upsert
from aerolith.sources.cubes import cubes
from aerolith.sources.readers import dump_lines, newest_items
from aerolith.streaming.pipelines import file_source, kafka_source, parsed, upsert_to

Read = Callable[[str], DataFrame | None]


def _hourly(df: DataFrame) -> DataFrame:
    return df.withColumns({"hour": F.col("hour").cast("timestamp"), "year": F.year("hour"), "month": F.month("hour"), "day": F.dayofmonth("hour")})


def _station(read: Read, settings: Settings) -> DataFrame:
    return _hourly(silver.station_hourly(read("sensor_bronze"), settings))


def _master(read: Read, settings: Settings) -> DataFrame:
    names = {"weather": "weather_hourly_silver", "surface": "surface_hourly_silver", "swath": "swath_daily_silver", "aerosol": "aerosol_daily_silver", "gradient": "gradient_silver", "trajectory": "trajectory_hourly_silver"}
    return gold.master(read("city_hourly_silver"), **{k: read(t) for k, t in names.items()}, series=settings.series)


def _weather(read: Read, settings: Settings) -> DataFrame:
    return _hourly(silver.weather_hourly(read("weather_bronze"), settings.place_pattern, settings))


def _paths(read: Read, settings: Settings) -> DataFrame:
    return path_features(read("trajectory_points_silver").where("direction = 'backward'"), read("pixel_grid_silver"), settings.trajectory)


def _clusters(read: Read, settings: Settings) -> DataFrame:
    points = read("trajectory_points_silver")
    wide = anchors(points, settings.trajectory.anchor_hours)
    labels = clusters(wide, [c for c in wide.columns if c.startswith(("lat", "lon"))], k=settings.trajectory.cluster_k_default)
    return cluster_points(points, labels)


def _surface(read: Read, settings: Settings) -> DataFrame:
    """Hourly surface fields of the cubes whose files the reanalysis table lists by month."""
    cells = read("surface_cubes")
    wide = pivot_max(cells.where(finite(F.col("value"))), ["time", "lat", "lon"], "variable", {c: (c, "value") for c in SURFACE_NAMES})
    return _hourly(silver.surface_hourly(wide.withColumnRenamed("time", "hour"), settings))


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumns({"year": F.year("date"), "month": F.month("date"), "day": F.dayofmonth("date")})


def _swath(read: Read, settings: Settings) -> DataFrame:
    return _dated(silver.swath_daily(read("swath_pixels"), settings))


def _grid(read: Read, settings: Settings) -> DataFrame:
    """Usable pixels with the share of their file's pixels in the box that are usable."""
    pixels = read("swath_pixels")
    good = silver.swath_grid(pixels, settings)
    every = bbox_filter(pixels, "lat", "lon", settings.bbox).groupBy("source_file").agg(F.count("*").alias("__all"))
    share = good.groupBy("source_file").agg(F.count("*").alias("__good")).join(every, "source_file").select("source_file", (100.0 * F.col("__good") / F.col("__all")).alias("valid_pct"))
    return _dated(good.join(share, "source_file"))


def _points(read: Read, settings: Settings) -> DataFrame:
    """Points of the dump files that the runs name."""
    spark = read("runs_bronze").sparkSession
    lines = dump_lines(spark, read("runs_bronze").where("status = 'success'"), f"{read.folder}/dump_files")
    return parse_dump(lines).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def _runs(read: Read, settings: Settings) -> DataFrame:
    """Backward runs of the hours over the threshold and forward ones of every run hour, planned where the month's meteorology covers them."""
    city = read("city_hourly_silver")
    high = threshold_hours(city, "hour", "pm25_mean", settings.runs.trigger_threshold).select(F.col("hour").cast("timestamp_ntz").alias("init_time"))
    days = city.agg(F.min("hour").cast("date").alias("a"), F.max("hour").cast("date").alias("b")).first()
    plans = planned_runs(high, "init_time", "backward", settings.runs, settings.center)
    if days["a"] is not None:
        plans = plans.unionByName(planned_runs(forward_starts(city, days["a"], days["b"], settings.runs), "init_time", "forward", settings.runs, settings.center))
    meteo = read("meteo_files_bronze")
    if meteo is not None:
        files = meteo.where("status = 'success'").select("year", "month", "arl_path", F.col("start_time").cast("timestamp_ntz").alias("start_time"), F.col("end_time").cast("timestamp_ntz").alias("end_time"))
        plans = newest_items(covered_runs(plans, files, settings.runs), "run_id", "start_time", "arl_path")
    path = F.concat(F.lit(f"{read.folder}/dump_files/tdump_"), "run_id")
    return plans.withColumns({"init_time": F.col("init_time").cast("timestamp"), "output_path": path, "status": F.lit("planned")})


#: Table built -> function of (reader of tables by name, settings), and the source whose days the dates choose.
JOBS: dict[str, tuple[Callable[[Read, Settings], DataFrame], str, str]] = {
    "station_hourly_silver": (_station, "sensor_bronze", "event_time"),
    "city_hourly_silver": (lambda r, s: _hourly(silver.city_hourly(r("station_hourly_silver"))), "station_hourly_silver", "hour"),
    "weather_hourly_silver": (_weather, "weather_bronze", "event_time"),
    "surface_hourly_silver": (_surface, "surface_cubes", "time"),
    "swath_daily_silver": (_swath, "swath_pixels", "date"),
    "pixel_grid_silver": (_grid, "swath_pixels", "date"),
    "aerosol_daily_silver": (lambda r, s: _dated(silver.aerosol_daily(r("aerosol_pixels"))), "aerosol_pixels", "date"),
    "runs_bronze": (_runs, "city_hourly_silver", "hour"),
    "trajectory_points_silver": (_points, "runs_bronze", "init_time"),
    "gradient_silver": (lambda r, s: _hourly(silver.gradient_hourly(r("station_hourly_silver"), s)), "station_hourly_silver", "hour"),
    "trajectory_clusters_silver": (_clusters, "trajectory_points_silver", "timestamp"),
    "trajectory_paths_silver": (_paths, "trajectory_points_silver", "timestamp"),
    "trajectory_hourly_silver": (lambda r, s: _hourly(hourly_features(r("trajectory_clusters_silver").where("direction = 'backward'"), r("trajectory_paths_silver"))), "trajectory_clusters_silver", "timestamp"),
    "master_hourly_gold": (_master, "city_hourly_silver", "hour"),
    "training_gold": (lambda r, s: gold.training(r("master_hourly_gold"), "v1", "all", s.series), "master_hourly_gold", "hour"),
}
#: Table of events -> the column of an event's time, and the columns that hold it as text, the first that parses counts.
STREAMS: dict[str, tuple[str, ...]] = {
    "weather_bronze": ("time",),
    "sensor_bronze": ("datetime_utc",),
    "swath_bronze": ("content_start",),
    "granule_bronze": ("time_start", "acquisition_date"),
    "reanalysis_files_bronze": ("start_time",),
}
#: Names of the surface fields in files.
SURFACE_ALIASES = {
    "u10": ["u10", "10u", "10m_u_component_of_wind"],
    "v10": ["v10", "10v", "10m_v_component_of_wind"],
    "blh": ["blh", "boundary_layer_height"],
    "sp": ["sp", "surface_pressure"],
    "t2m": ["t2m", "2t", "2m_temperature"],
    "d2m": ["d2m", "2d", "2m_dewpoint_temperature"],
    "tp": ["tp", "total_precipitation"],
    "msl": ["msl", "msl_pressure", "mean_sea_level_pressure"],
}
SURFACE_NAMES = list(SURFACE_ALIASES)
#: Of these, the dates choose whole trajectories, by their start.
WHOLE = frozenset(["trajectory_paths_silver", "trajectory_clusters_silver"])


def _reach(name: str, settings: Settings) -> timedelta:
    """How far the windows of a table see past the days that are built."""
    series = settings.series
    return timedelta(days=-(-max(*series.lag_hours, *series.rolling_hours, *series.horizons_hours) // 24)) if name == "master_hourly_gold" else timedelta(0)


def run(spark: SparkSession, name: str, tables: str, start: date | None = None, end: date | None = None, refresh: bool = False, settings: Settings = Settings()) -> None:
    """Build a table of the days from start to end and write it; `refresh` replaces the rows of the hours that are built, else rows are merged by key."""
    build, source, column = JOBS[name]
    target, reach = TABLES[name], _reach(name, settings)

    def read(table: str) -> DataFrame | None:
        df = cubes(spark, f"{tables}/{table}", SURFACE_ALIASES) if table == "surface_cubes" else read_or_none(spark, f"{tables}/{table}")
        if df is None or table != source:
            return df
        if name in WHOLE:
            low, high = start or date(1, 1, 1), (end or date(9998, 12, 31)) + timedelta(days=1)
            return df.join(by_init_window(df, low, high).select("traj_id").distinct(), "traj_id", "left_semi") if start or end else df
        return date_range(df, column, start and start - reach, end and end + reach)

    read.folder = tables.rstrip("/")
    out = build(read, settings)
    if reach:
        out = date_range(out, "hour", start, end)
    if "spark_processed_at" not in out.columns:
        out = out.withColumn("spark_processed_at", F.current_timestamp())
    have = dict(out.dtypes)
    out = out.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.schema().fields))
    path = f"{tables}/{name}"
    if not refresh:
        upsert(out, path, target.keys, target.partition_by)
    elif "hour" in target.keys:
        full_refresh(out, path, "hour", target.partition_by)
    elif start or end:
        raise ValueError(f"{name} has no hours: refresh it without dates")
    else:
        replace_table(out, path, target.partition_by)


def run_stream(name: str, events: DataFrame, tables: str, once: bool = True, interval: str = "30 seconds") -> StreamingQuery:
    """Merge a stream of JSON events (column value) into a bronze table by its keys: the last ingested row of an event stays.

    Columns are those of the registry, missing ones null; malformed lines, and events without a key, are dropped.  Where no time parses, the event's time and its date parts are null.
    """
    target = TABLES[name]
    fields = {f.name: f for f in target.schema()}
    times = STREAMS[name]
    body = StructType([StructField(f.name, StringType() if f.name in times or f.name == "ingest_time" else f.dataType) for f in fields.values()])
    rows = parsed(events, StructType([f for f in body if f.name not in ("event_time", "year", "month", "day", "hour") or f.name in times]), times, drop_malformed=True)
    rows = rows.withColumns({"ingest_time": iso_time(F.col("ingest_time")), "spark_processed_at": F.current_timestamp()})
    rows = rows.withColumns({c: iso_time(F.col(c)) for c in times if isinstance(fields[c].dataType, TimestampType)})
    rows = rows.select(*(F.col(n).cast(f.dataType).alias(n) for n, f in fields.items()))
    return upsert_to(rows, f"{tables}/{name}", f"{tables}/_streams/{name}", list(target.keys), ["ingest_time"], list(target.partition_by), once, interval)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("name", choices=sorted([*JOBS, *STREAMS]))
    parser.add_argument("--tables", required=True)
    parser.add_argument("--start-date", type=date.fromisoformat)
    parser.add_argument("--end-date", type=date.fromisoformat)
    parser.add_argument("--full-refresh", default="0")
    parser.add_argument("--events")
    parser.add_argument("--servers")
    parser.add_argument("--topic")
    parser.add_argument("--keep-running", default="0")
    args = parser.parse_args(argv)
    if args.name in STREAMS and not args.events and not (args.servers and args.topic):
        parser.error("a stream needs --events, or --servers and --topic")
    spark = SparkSession.builder.appName(f"aerolith {args.name}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.name in STREAMS:
        source = file_source(spark, args.events) if args.events else kafka_source(spark, args.servers, args.topic, "earliest")
        run_stream(args.name, source, args.tables, not truthy(args.keep_running)).awaitTermination()
        return
    run(spark, args.name, args.tables, args.start_date, args.end_date, truthy(args.full_refresh))


if __name__ == "__main__":
    main()
