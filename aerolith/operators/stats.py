"""Aggregates: series statistics, data quality, two-level means, errors of forecasts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.operators.joins import null_safe_join


def series_stats(df: DataFrame, by: Sequence[str], value: str, station: Sequence[str], prefix: str, coverage: str | None = None) -> DataFrame:
    """Median (an actual value), mean, min, max, sample deviation of a value; distinct stations; mean coverage.

    A station's parts are joined by a colon, nulls left out.  The median is exact and has a pass of its own, as its
    counts of values would be sent once a station beside the distinct stations; a task holds a count for each different value of a group.
    """
    aggregates = [
        F.avg(value).alias(f"{prefix}_mean"),
        F.min(value).alias(f"{prefix}_min"),
        F.max(value).alias(f"{prefix}_max"),
        F.stddev_samp(value).alias(f"{prefix}_std"),
        F.count_distinct(F.concat_ws(":", *station)).cast("int").alias("station_count"),
    ]
    if coverage:
        aggregates.append(F.avg(coverage).alias("coverage_avg"))
    median = df.groupBy(*by).agg(F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{value}`)").alias(f"{prefix}_median"))
    return null_safe_join(median, df.groupBy(*by).agg(*aggregates), by)


def quality_report(df: DataFrame, columns: Sequence[str], bounds: Sequence[str] = (), conditions: Mapping[str, Column] | None = None) -> DataFrame:
    """One row of rows, null ratios, bounds and conditional counts, in one pass."""
    ratio = lambda c: F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0))
    return df.agg(
        F.count("*").alias("rows"),
        *(ratio(c).alias(f"null_ratio_{c}") for c in columns),
        *(f(c).alias(f"{n}_{c}") for c in bounds for n, f in (("min", F.min), ("max", F.max))),
        *(F.count_if(c).alias(name) for name, c in (conditions or {}).items()),
    )


def mode_per_key(df: DataFrame, by: Sequence[str], value: str, unit: str, out: str) -> DataFrame:
    """The value with the most distinct units; ties go to the smaller value."""
    counts = df.groupBy(*by, value).agg(F.count_distinct(unit).alias("__n"))
    return counts.groupBy(*by).agg(F.min_by(value, F.struct(-F.col("__n"), F.col(value))).alias(out))


def pivot_max(df: DataFrame, by: Sequence[str], label: str, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Output column -> (label value, value column): the greatest value of rows with that label."""
    return df.groupBy(*by).agg(*(F.max(F.when(F.col(label) == k, F.col(v))).alias(name) for name, (k, v) in columns.items()))


def pivot_mean(df: DataFrame, by: Sequence[str], label: str, value: str, labels: Sequence[str]) -> DataFrame:
    """One mean per label, long to wide; the labels are given, so no extra pass finds them."""
    return df.groupBy(*by).pivot(label, list(labels)).agg(F.avg(value))


def pixel_stats(df: DataFrame, by: Sequence[str], value: str, valid: Column, source: str, seen_at: str | None = None) -> DataFrame:
    """Statistics of valid pixels (population deviation), counts, share in percent, first sighting, sources joined by ';'.

    Groups without a valid pixel are dropped.
    """
    v = F.when(valid, F.col(value))
    out = df.groupBy(*by).agg(
        F.avg(v).alias("value_mean"),
        F.min(v).alias("value_min"),
        F.max(v).alias("value_max"),
        F.stddev_pop(v).alias("value_std"),
        F.count(v).alias("valid_pixel_count"),
        F.count("*").alias("total_pixel_count"),
        F.array_join(F.array_sort(F.collect_set(source)), ";").alias("source_file"),
        *([F.min(seen_at).alias("overpass_time_utc")] if seen_at else []),
    )
    return out.where("valid_pixel_count > 0").withColumn("valid_pct", F.col("valid_pixel_count") / F.col("total_pixel_count") * 100.0)


def merged_bands(df: DataFrame, keys: Sequence[str], bands: Sequence[str]) -> DataFrame:
    """One row per band and pixel: keys, band, value."""
    pairs = F.array(*(F.struct(F.lit(b).alias("band"), F.col(b).alias("value")) for b in bands))
    return df.select(*keys, F.inline(pairs))


def daily_of_files(files: DataFrame, day: str, means: Sequence[str], low: str, high: str, spread: str, valid: str, total: str, tile: str, source: str) -> DataFrame:
    """A day's unweighted mean of its files' means, extreme values, mean spread, pixel sums, tiles and sorted sources."""
    return files.groupBy(day).agg(
        *(F.avg(m).alias(m) for m in means),
        F.min(low).alias(low),
        F.max(high).alias(high),
        F.avg(spread).alias(spread),
        F.sum(valid).alias("valid_pixel_count"),
        F.sum(total).alias("total_pixel_count"),
        F.try_divide(F.sum(valid) * 100.0, F.sum(total)).alias("valid_pct"),
        F.count_distinct(tile).cast("int").alias("tile_count"),
        F.array_sort(F.collect_list(source)).alias("source_files"),
    )


def region_average(df: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Means that leave out nulls and NaN."""
    return df.groupBy(*by).agg(*(F.avg(F.when(~F.isnan(F.col(v)), F.col(v))).alias(v) for v in values))


def regression_errors(df: DataFrame, truth: str, guess: str, by: Sequence[str] = ()) -> DataFrame:
    """mae, rmse and mape in percent (true values of 0 left out of it)."""
    gap = F.col(truth) - F.col(guess)
    share = F.when(F.col(truth) != 0, F.abs(F.try_divide(gap, F.col(truth))))
    return df.where(gap.isNotNull()).groupBy(*by).agg(F.avg(F.abs(gap)).alias("mae"), F.sqrt(F.avg(gap * gap)).alias("rmse"), (F.avg(share) * 100.0).alias("mape"))


def percent_of_total(df: DataFrame, value: str, by: Sequence[str] = (), out: str = "percent") -> DataFrame:
    """Each row's share of its group's sum.  Without `by` the sum is one row, joined back, not a window over all rows."""
    if by:
        return df.withColumn(out, F.try_divide(F.col(value) * 100.0, F.sum(value).over(Window.partitionBy(*by))))
    total = df.agg(F.sum(value).alias("__total"))  # one row
    return df.join(F.broadcast(total)).withColumn(out, F.try_divide(F.col(value) * 100.0, F.col("__total"))).drop("__total")


def ordered_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *by)


def non_null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: how many values of each column are not null."""
    return df.agg(*(F.count(c).alias(c) for c in columns))


def aggregated(df: DataFrame, by: Sequence[str], functions: Mapping[str, str]) -> DataFrame:
    """Column name -> name of an aggregate function, as columns `column_function`."""
    return df.groupBy(*by).agg(*(F.expr(f"{f}(`{c}`)").alias(f"{c}_{f}") for c, f in functions.items()))
