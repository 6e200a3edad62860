"""Trajectories: dump lines to points, features along paths, hourly features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.config import Trajectory
from aerolith.functions.times import dump_year
from aerolith.functions.units import guarded_ratio
from aerolith.operators.dedup import latest_per_key
from aerolith.operators.spatial import nearest_within
from aerolith.operators.stats import mode_per_key

#: Words of heading lines; places of a point's values among a line's tokens.
HEADINGS = "press|trajectory|meteorology|job id"
FIELDS = {"traj_no": 0, "year": 2, "month": 3, "day": 4, "hour": 5, "minute": 6, "forecast_hour": 7, "age_h": 8, "lat": 9, "lon": 10, "alt_m": 11}
#: Date and time of a line without the numbers' places, and a number of such a line.
NUMBER = r"(?i)^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$|^[+-]?(nan|inf|infinity)$"
ISO_DATE, ISO_TIME, PLAIN_NUMBER = r"^\d{4}-\d{2}-\d{2}$", r"^(\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)(?:Z|[+-]\d{2}:\d{2})?$", r"^-?\d+(\.\d+)?$"


def parse_dump(lines: DataFrame, run: str = "run_id", direction: str = "direction", line: str = "value") -> DataFrame:
    """Points of dump lines, without Python: 12 tokens or more, else an ISO time with latitude, longitude, altitude.

    A line gives one point at most.  Blank lines, comments, headings, and lines with a bad number, date or place are dropped; an altitude may be NaN.  Whole
    numbers lose what follows the point, but hours are rounded, halves to the even.  A line of the second form takes the first two
    neighbouring numbers that are a place; it has no age, and the number 0.
    """
    text = F.trim(F.col(line), F.lit(" \t\r\n\f\v"))
    rows = lines.where((text != "") & ~text.startswith("#") & ~F.lower(text).rlike(HEADINGS)).select(F.col(run).alias("run_id"), F.col(direction).alias("direction"), F.split(text, r"\s+").alias("__t"))

    def once(**columns: Column) -> DataFrame:
        """`rows` with more columns, evaluated once a line and not wherever they are used."""
        return rows.select("*", F.inline(F.array(F.struct(*(c.alias(k) for k, c in columns.items())))))

    rows = rows.select("run_id", "direction", F.explode(F.array("__t")).alias("__t"))
    iso = F.get("__t", F.lit(0)).rlike(ISO_DATE) & F.get("__t", F.lit(1)).rlike(ISO_TIME) & (F.size("__t") >= 5)
    stamp = F.try_to_timestamp(F.concat_ws(" ", F.get("__t", F.lit(0)), F.regexp_extract(F.get("__t", F.lit(1)), ISO_TIME, 1))).cast("timestamp_ntz")
    plain = F.transform(F.filter(F.slice("__t", F.lit(3), F.greatest(F.size("__t") - 2, F.lit(0))), lambda x: x.rlike(PLAIN_NUMBER)), lambda x: x.cast("double"))
    # By their pattern, as a cast also takes numbers with a type's letter.
    number = lambda x: F.when(x.rlike(NUMBER), x.try_cast("double"))
    numbers = {f"__{k}": F.when(F.size("__t") >= 12, number(F.get("__t", F.lit(i)))) for k, i in FIELDS.items()}
    rows = once(**numbers, __v=F.when(iso, plain), __iso=F.when(iso, stamp))
    placed = lambda lat, lon: lat.between(-90, 90) & lon.between(-180, 180)
    pairs = F.transform("__v", lambda x, i: F.struct(x.alias("lat"), F.get("__v", i + 1).alias("lon"), F.get("__v", i + 2).alias("alt_m")))
    rows = once(__place=F.get(F.filter(pairs, lambda p: placed(p["lat"], p["lon"])), F.lit(0)))
    at = lambda k: F.nanvl(F.col(f"__{k}"), F.lit(None).cast("double"))
    whole = {k: (F.rint(at(k)) if k in ("forecast_hour", "age_h") else at(k)).cast("int") for k in FIELDS if k not in ("lat", "lon", "alt_m")} | {"lat": at("lat"), "lon": at("lon"), "alt_m": F.col("__alt_m")}
    whole["year"] = dump_year(whole["year"])
    stamp = F.try_make_timestamp_ntz(*(whole[k] for k in ("year", "month", "day", "hour", "minute")), F.lit(0))
    good = stamp.isNotNull() & placed(whole["lat"], whole["lon"])
    for c in whole.values():
        good &= c.isNotNull()
    first = F.when(good, F.struct(*(c.alias(k) for k, c in whole.items()), stamp.alias("timestamp")))
    time = F.col("__iso")
    parts = {"traj_no": F.lit(0), "year": F.year(time), "month": F.month(time), "day": F.dayofmonth(time), "hour": F.hour(time), "minute": F.minute(time), "forecast_hour": F.lit(None), "age_h": F.lit(None)}
    place = {k: F.col(f"__place.{k}") for k in ("lat", "lon", "alt_m")}
    second = F.when(time.isNotNull() & F.col("__place").isNotNull(), F.struct(*(c.cast("int").alias(k) for k, c in parts.items()), *(c.alias(k) for k, c in place.items()), time.alias("timestamp")))
    points = once(__p=F.coalesce(first, second)).where("__p is not null").select("run_id", "direction", "__p.*")
    return points.withColumn("traj_id", F.concat(F.col("run_id"), F.lit("-traj"), F.col("traj_no").cast("string")))


def with_init(points: DataFrame, traj: str = "traj_id", age: str = "age_h", ts: str = "timestamp") -> DataFrame:
    """Points with the time of their trajectory's age 0; trajectories without one are dropped."""
    init = points.where(F.col(age) == 0).groupBy(traj).agg(F.min(ts).alias("init_time"))
    return points.join(init, traj)


def by_init_window(points: DataFrame, start, end, traj: str = "traj_id") -> DataFrame:
    """All points of the trajectories that start within [start, end), whole, whenever their points are."""
    return with_init(points, traj).where((F.col("init_time") >= F.lit(start)) & (F.col("init_time") < F.lit(end)))


def anchors(points: DataFrame, hours: Sequence[int] = Trajectory().anchor_hours) -> DataFrame:
    """One row per trajectory: places at the anchor ages, as lat_0, lon_0, alt_0, lat_m6, .."""
    name = lambda p, h: f"{p}_m{-h}" if h < 0 else f"{p}_{h}"
    parts = {"lat": "lat", "lon": "lon", "alt": "alt_m"}
    return points.groupBy("traj_id", "direction").agg(*(F.max(F.when(F.col("age_h") == h, F.col(c))).alias(name(p, h)) for h in hours for p, c in parts.items()))


def path_features(points: DataFrame, pixels: DataFrame, settings: Trajectory = Trajectory()) -> DataFrame:
    """Per trajectory: NO2 mean, maximum, deviation and aerosol mean of the nearest pixels of the day along its path, and their ratio.

    `points`: traj_id, age_h, timestamp, lat, lon; `pixels`: product, date, lat, lon, value.
    """
    known = with_init(points.where("traj_id is not null and timestamp is not null and age_h is not null"))
    window = known.where(F.col("age_h").between(settings.path_start_h, settings.path_end_h)).select("traj_id", F.col("timestamp").cast("date").alias("obs_date"), "lat", "lon")
    grid = pixels.where(F.col("date").isNotNull() & F.col("product").isin("NO2", "AER_AI")).select("product", F.col("date").alias("obs_date"), F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"), "value")
    near = nearest_within(window, grid, "lat", "lon", "p_lat", "p_lon", ["obs_date", "product"], settings.max_distance_deg, ["value"], ["traj_id"])
    of = lambda p: F.when(F.col("product") == p, F.col("value"))
    found = near.groupBy("traj_id").agg(
        F.avg(of("NO2")).alias("path_no2_mean"), F.max(of("NO2")).alias("path_no2_max"), F.stddev_samp(of("NO2")).alias("path_no2_std"), F.avg(of("AER_AI")).alias("path_aer_mean")
    )
    out = known.select("traj_id").distinct().join(found, "traj_id", "left")
    return out.withColumn("path_no2_aer_ratio", F.when(F.col("path_aer_mean") != 0, guarded_ratio(F.col("path_no2_mean"), F.col("path_aer_mean"))))


def matched_pixels(points: DataFrame, paths: DataFrame) -> DataFrame:
    """One row: trajectories with a start, those whose path met a pixel, those that met none, the ratio (null without trajectories), and the bounds of the NO2 means."""
    known = with_init(points.where("traj_id is not null and timestamp is not null and age_h is not null")).select("traj_id").distinct()
    met = F.col("path_no2_mean").isNotNull() | F.col("path_aer_mean").isNotNull()
    rows = known.join(paths.select("traj_id", met.alias("__met"), "path_no2_mean"), "traj_id", "left")
    n, matched = F.count("*"), F.count_if("__met")
    return rows.agg(n.alias("input_count"), matched.alias("matched"), (n - matched).alias("unmatched"), F.when(n > 0, matched / n).alias("matched_ratio"), F.min("path_no2_mean").alias("no2_min"), F.max("path_no2_mean").alias("no2_max"))


def hourly_features(clustered: DataFrame, paths: DataFrame) -> DataFrame:
    """Per start hour: the dominant cluster, the number of trajectories, mean source place and mean path features."""
    init = clustered.where("age_h = 0").withColumn("hour", F.date_trunc("hour", "timestamp").cast("timestamp_ntz"))
    init = latest_per_key(init, ["traj_id", "hour"], [F.col("timestamp").desc(), F.col("cluster_id"), F.col("source_lat"), F.col("source_lon")])
    path = ["path_no2_mean", "path_aer_mean", "path_no2_aer_ratio"]
    joined = init.select("traj_id", "hour", "cluster_id", "source_lat", "source_lon").join(paths.select("traj_id", *path), "traj_id", "left")
    means = joined.groupBy("hour").agg(F.count_distinct("traj_id").alias("n_traj"), *(F.avg(c).alias(c) for c in ["source_lat", "source_lon", *path]))
    return means.join(mode_per_key(joined, ["hour"], "cluster_id", "traj_id", "dominant_cluster"), "hour", "left")
