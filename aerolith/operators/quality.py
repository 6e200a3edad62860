"""Filters: ranges, coverage, dates, masks of pixels."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.config import BBox, Quality
from aerolith.functions.text import normalized_name

#: Least quality of a pixel by product, and upper bounds of surface measurements.
QA_THRESHOLDS = {"NO2": 0.75, "SO2": 0.75, "CO": 0.5, "O3": 0.5, "AER_AI": 0.5}
UPPER_BOUNDS = {"pm25": 500.0, "pm10": 600.0, "no2": 200.0, "co": 50.0, "so2": 500.0, "o3": 500.0}


def quality_filter(df: DataFrame, value: str, bounds: Quality = Quality(), coverage: str | None = None) -> DataFrame:
    """Rows whose value lies in the range and whose coverage is unknown or high enough."""
    keep = F.col(value).between(bounds.min_value, bounds.max_value)
    if coverage:
        keep &= F.col(coverage).isNull() | (F.col(coverage) >= bounds.min_coverage_pct)
    return df.where(keep)


def parameter_filter(df: DataFrame, column: str, name: str) -> DataFrame:
    """Rows whose parameter has this name, whatever its case and punctuation."""
    return df.where(normalized_name(F.col(column)) == name)


def date_range(df: DataFrame, column: str, start: date | None = None, end: date | None = None) -> DataFrame:
    """Rows from `start` to `end`, both whole days; bounds on the raw column reach the scan."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(column) < F.lit(end + timedelta(days=1)))
    return df


def months_between(df: DataFrame, year: str, month: str, start: date, end: date) -> DataFrame:
    """Rows whose year and month lie between those of two dates."""
    number = F.col(year) * 12 + F.col(month)
    return df.where(number.between(start.year * 12 + start.month, end.year * 12 + end.month))


def bbox_filter(df: DataFrame, lat: str, lon: str, box: BBox = BBox()) -> DataFrame:
    return df.where(in_box(F.col(lat), F.col(lon), box))


def in_box(lat: Column, lon: Column, box: BBox) -> Column:
    return lat.between(box.south, box.north) & lon.between(box.west, box.east)


def name_or_box(df: DataFrame, names: list[str], pattern: str, lat: str, lon: str, box: BBox = BBox()) -> DataFrame:
    """Rows of which a name matches the pattern, or that lie in the box."""
    named = F.lower(F.concat_ws(" ", *names)).rlike(pattern)
    return df.where(named | F.coalesce(in_box(F.col(lat), F.col(lon), box), F.lit(False)))


def overlapping(df: DataFrame, start: str, end: str, lo: Column, hi: Column) -> DataFrame:
    """Rows whose interval [start, end] meets [lo, hi]."""
    return df.where((F.col(end) >= lo) & (F.col(start) <= hi))


def null_out_of_range(df: DataFrame, parameter: str, value: str, upper: Mapping[str, float] = UPPER_BOUNDS) -> DataFrame:
    """Values below 0 or above their parameter's bound become null; parameters without a bound stay."""
    bound = F.element_at(F.create_map(*(F.lit(x) for kv in upper.items() for x in kv)), normalized_name(F.col(parameter)))
    return df.withColumn(value, F.when(bound.isNull() | F.col(value).between(0.0, bound), F.col(value)))


def threshold_hours(df: DataFrame, hour: str, value: str, threshold: float) -> DataFrame:
    """The distinct hours with a value of at least the threshold, in order."""
    return df.where(F.col(value) >= threshold).select(hour).distinct().orderBy(hour)


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def qa_threshold(product: Column, thresholds: Mapping[str, float] = QA_THRESHOLDS) -> Column:
    """The least quality of a product's pixels, within [0, 1]; 0.5 for products without one."""
    least = F.lit(0.5)
    for name, bound in thresholds.items():
        least = F.when(product == name, min(max(bound, 0.0), 1.0)).otherwise(least)
    return least


def good_pixels(df: DataFrame, product: str, value: str, qa: str, lat: str, lon: str, box: BBox = BBox(), thresholds: Mapping[str, float] = QA_THRESHOLDS) -> DataFrame:
    """Pixels in the box with a finite value and the quality that their product asks for."""
    return df.where(finite(F.col(value)) & in_box(F.col(lat), F.col(lon), box) & (F.col(qa) >= qa_threshold(F.col(product), thresholds)))


def clear_bits(qa: Column, relaxed: bool = False) -> Column:
    """Whether the two lowest bits of a quality word allow use; relaxed takes one grade more."""
    return qa.bitwiseAND(F.lit(0b11)) <= (2 if relaxed else 1)


def where_sql(df: DataFrame, predicate: str, **values) -> DataFrame:
    """Rows for which a SQL predicate holds; `:name` in it stands for a value, which is never read as SQL."""
    return df.sparkSession.sql(f"SELECT * FROM {{rows}} WHERE {predicate}", args=values, rows=df)
