"""Joins that the compositions share."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.config import Center, Runs
from aerolith.functions.text import run_id


def left_chain(base: DataFrame, sides: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """`base` with each side joined on the same keys; equal keys let the shuffles be shared, sizes decide on broadcasts."""
    return reduce(lambda df, side: df.join(side, list(on), "left"), sides, base)


def null_safe_join(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equal keys join, and null with null; the keys come from `a`."""
    renamed = b.select(*(F.col(c).alias(f"__{c}") if c in keys else F.col(c) for c in b.columns))
    condition = reduce(lambda x, y: x & y, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    return a.join(renamed, condition, how).drop(*(f"__{k}" for k in keys))


def null_safe_pairs(a: DataFrame, b: DataFrame, keys: Sequence[str], value_a: str, value_b: str) -> DataFrame:
    """Columns keys, pairs, total: for each key that both sides have (null with null) the pairs of `null_safe_join` and the sum of both values over them.

    Each side is counted by key before the join, so no pair is made: a pair's sum adds each value once for every row of the other side.  A null value adds nothing with
    any row, as its pair's sum is null; a key none of whose pairs has both values has the total null.
    """
    side = lambda df, value: df.groupBy(*keys).agg(F.count("*").alias("__n"), F.count(value).alias("__known"), F.sum(value).alias("__sum"))
    right = side(b, value_b).withColumnsRenamed({c: f"{c}_b" for c in ("__n", "__known", "__sum")})
    both = null_safe_join(side(a, value_a), right, keys)
    total = F.col("__sum") * F.col("__known_b") + F.col("__sum_b") * F.col("__known")
    return both.select(*keys, (F.col("__n") * F.col("__n_b")).alias("pairs"), total.alias("total"))


def filled_from(a: DataFrame, b: DataFrame, key_a: str, key_b: str, columns: Sequence[str]) -> DataFrame:
    """`a` with its null columns filled from the row of `b` whose key has another name."""
    side = b.select(F.col(key_b).alias("__key"), *(F.col(c).alias(f"__{c}") for c in columns))
    joined = a.join(side, F.col(key_a) == F.col("__key"), "left")
    return joined.select(*(F.coalesce(c, f"__{c}").alias(c) if c in columns else c for c in a.columns))


def planned_runs(starts: DataFrame, init: str, direction: str, settings: Runs = Runs(), center: Center = Center()) -> DataFrame:
    """One run per start, latitude offset, longitude offset and altitude, with its id and signed duration."""
    back = direction == "backward"
    altitudes = settings.backward_altitudes_m if back else settings.forward_altitudes_m
    each = lambda values: F.explode(F.array(*(F.lit(float(v)) for v in values)))
    rows = starts.select(F.col(init).alias("init_time")).distinct()
    rows = rows.select("*", each([center.lat + d for d in settings.offsets_deg]).alias("init_lat"))
    rows = rows.select("*", each([center.lon + d for d in settings.offsets_deg]).alias("init_lon"))
    rows = rows.select("*", each(altitudes).alias("init_alt_m"))
    hours = -settings.backward_hours if back else settings.forward_hours
    ids = run_id(F.lit(direction), F.col("init_time"), F.col("init_lat"), F.col("init_lon"), F.col("init_alt_m"))
    return rows.select(ids.alias("run_id"), F.lit(direction).alias("direction"), "init_time", F.lit(hours).alias("duration_hours"), "init_lat", "init_lon", "init_alt_m")


def forward_starts(df: DataFrame, start: date, end: date, settings: Runs = Runs()) -> DataFrame:
    """The run hours of every day from start to end, as column init_time; `df` gives the session."""
    days = (end - start).days + 1
    times = [F.lit(h) for h in settings.run_hours_utc]
    base = df.sparkSession.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).cast("timestamp_ntz").alias("day"), F.explode(F.array(*times)).alias("h"))
    return base.select((F.col("day") + F.make_dt_interval(F.lit(0), F.col("h"))).alias("init_time"))


def covered_runs(runs: DataFrame, files: DataFrame, settings: Runs = Runs()) -> DataFrame:
    """Runs whose month has a file that covers them and one interval more, at the far end, on both sides of the start.

    `files`: year, month, start_time, end_time (null bounds cover all).
    """
    whole = F.make_dt_interval(F.lit(0), F.col("duration_hours"))
    more = F.lit(timedelta(hours=max(0, settings.meteo_interval_hours)))
    stop = F.col("init_time") + whole
    forward = F.col("duration_hours") >= 0
    low = F.when(forward, F.col("init_time")).otherwise(stop - more)
    high = F.when(forward, stop + more).otherwise(F.col("init_time"))
    keyed = runs.withColumn("year", F.year("init_time")).withColumn("month", F.month("init_time"))
    fits = F.col("start_time").isNull() | F.col("end_time").isNull() | ((low >= F.col("start_time")) & (high <= F.col("end_time")))
    return keyed.join(files, ["year", "month"]).where(fits)
