"""Hourly series: dense grids, lags, leads, rolling windows, chronological splits.

A window over a whole series runs in one task.  On a dense grid a row needs only its neighbours within the reach of
the frame, so rows are dealt out by month, rows near a month's edge are lent to the next month, and
every month is a window of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.shared import staged


def hour_grid(df: DataFrame, hour: str = "hour", by: Sequence[str] = ()) -> DataFrame:
    """Every hour from the first to the last (of each `by`); nothing is collected."""
    bounds = df.groupBy(*by).agg(F.min(hour).alias("lo"), F.max(hour).alias("hi")).where("lo is not null")
    return bounds.select(*by, F.explode(F.sequence("lo", "hi", F.expr("interval 1 hour"))).alias(hour))


def densify(df: DataFrame, hour: str = "hour", by: Sequence[str] = ()) -> DataFrame:
    """The rows of `df` on their grid; hours without a row are null."""
    return hour_grid(df, hour, by).join(df, [*by, hour], "left")


def over_hours(df: DataFrame, hour: str, columns: dict, reach_hours: int, by: Sequence[str] = ()) -> DataFrame:
    """Add columns, each a function of a window ordered by hour, on a dense grid.

    No frame may reach further than `reach_hours`, less than a month.
    """
    own = F.date_trunc("month", hour)
    shifts = [F.lit(0), F.lit(-reach_hours), F.lit(reach_hours)]
    months = F.array_distinct(F.array(*(F.date_trunc("month", F.col(hour) + F.make_dt_interval(F.lit(0), s)) for s in shifts)))
    lent = df.select("*", own.alias("__own"), F.explode(months).alias("__month"))
    w = Window.partitionBy(*by, "__month").orderBy(hour)
    out = lent.select("*", *(f(w).alias(name) for name, f in columns.items()))
    return out.where("__own = __month").drop("__own", "__month")


def lag_of(value: str, hours: int):
    return lambda w: F.lag(value, hours).over(w)


def lead_of(value: str, hours: int):
    return lambda w: F.lead(value, hours).over(w)


def rolling(aggregate: Callable[[str], Column], value: str, hours: int, include_current: bool = True):
    """An aggregate of a column over the last `hours` rows, with or without the current one; nulls are left out."""
    frame = (-(hours - 1), 0) if include_current else (-hours, -1)
    return lambda w: aggregate(value).over(w.rowsBetween(*frame))


def gap_lag(value: str, hour: str, hours: int):
    """The value `hours` rows ago if it is as many hours old: for series with gaps."""
    age = lambda w: F.unix_timestamp(F.col(hour).cast("timestamp")) - F.unix_timestamp(F.lag(hour, hours).over(w).cast("timestamp"))
    return lambda w: F.when(age(w) == hours * 3600, F.lag(value, hours).over(w))


def feature_columns(value: str, prefix: str, lags: Sequence[int], windows: Sequence[int], horizons: Sequence[int]) -> dict:
    """Lags, rolling means (for the longest window also maximum and sample deviation), and leads."""
    out = {f"{prefix}_lag_{n}h": lag_of(value, n) for n in lags}
    for n in windows:
        out[f"{prefix}_roll_mean_{n}h"] = rolling(F.avg, value, n)
    longest = max(windows)
    out[f"{prefix}_roll_max_{longest}h"] = rolling(F.max, value, longest)
    out[f"{prefix}_roll_std_{longest}h"] = rolling(F.stddev_samp, value, longest)
    return out | {f"{prefix}_next_{n}h": lead_of(value, n) for n in horizons}


def ranked(df: DataFrame, order: str | Sequence[str], rank: str = "rank", total: str = "total", ties: Sequence[str] = ()) -> DataFrame:
    """Add each row's number from 1 and the count of rows, in the order of `order` and then `ties`, without a window over all rows.

    Rows are dealt out by ranges of the order and sorted within them; each row's place in its task and the rows of the
    tasks before it make its number.  Rows that are equal in all of these are told apart by a hash of the whole row and, if that is equal, by where they were read, so
    many rows of one time, or of equal values, still make even tasks.  The sorted rows are staged, as numbers that are computed twice would differ.  The driver
    learns one count for each task.  An empty table has no rows.
    """
    keys = [order] if isinstance(order, str) else list(order)
    tie = [F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)).alias("__hash"), F.monotonically_increasing_id().alias("__read")]
    dealt = [*keys, *ties, "__hash", "__read"]
    rows = df.select("*", *tie).repartitionByRange(*dealt).sortWithinPartitions(*dealt)
    rows = staged(rows.withColumn("__place", F.monotonically_increasing_id()).drop("__hash", "__read"), "ranked")
    task = F.shiftright("__place", 33)
    counts = sorted((r["task"], r["n"]) for r in rows.groupBy(task.alias("task")).agg(F.count("*").alias("n")).collect())
    sums, before = [], 0
    for k, n in counts:
        sums.append((k, before, before + n))
        before += n
    # One row a task.
    known = F.broadcast(rows.sparkSession.createDataFrame([(k, lo) for k, lo, _ in sums], "__task long, __before long"))
    own = F.col("__place").bitwiseAND(F.lit(2**33 - 1)) + 1
    out = rows.withColumn("__task", task).join(known, "__task").withColumn(rank, own + F.col("__before")).withColumn(total, F.lit(before).cast("long"))
    return out.drop("__task", "__before", "__place")


def time_split(df: DataFrame, order: str, train: float = 0.70, validation: float = 0.85, out: str = "split", ties: Sequence[str] = ()) -> DataFrame:
    """train, validation and test by position in time (of equal times, in `ties`): the share of rows before a row decides."""
    share = (F.col("__rank") - 1) / F.col("__total")
    rows = ranked(df, order, "__rank", "__total", ties)
    return rows.withColumn(out, F.when(share < train, "train").when(share < validation, "validation").otherwise("test")).drop("__rank", "__total")


def day_list(start: Column, end: Column) -> Column:
    """All days from start to end."""
    return F.sequence(start.cast("date"), end.cast("date"), F.expr("interval 1 day"))


def month_list(start: Column, end: Column) -> Column:
    """First days of all months from start to end."""
    return F.sequence(F.trunc(start.cast("date"), "month"), F.trunc(end.cast("date"), "month"), F.expr("interval 1 month"))


def latest_record(df: DataFrame, by: Sequence[str], ts: str, values: Sequence[str]) -> DataFrame:
    """Of each key the values at its greatest time; ties go to the greatest values."""
    best = F.max(F.struct(ts, *values)).alias("__best")
    return df.where(F.col(ts).isNotNull()).groupBy(*by).agg(best).select(*by, f"__best.{ts}", *(f"__best.{v}" for v in values))
