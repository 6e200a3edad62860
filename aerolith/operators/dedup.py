"""One row per key, and counts of what is too many."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(*columns: str) -> list[Column]:
    """Descending order by each column, nulls last."""
    return [F.col(c).desc_nulls_last() for c in columns]


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in this order.  Partial group limits cut hot keys before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__place", place).where("__place = 1").drop("__place")


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: by how many the rows exceed the keys."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_count"))


def insert_new(target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """The rows of `source` whose key `target` lacks."""
    t = target.select(*(F.col(k).alias(f"__{k}") for k in keys)).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) if null_safe else F.col(k) == F.col(f"__{k}") for k in keys]
    condition = same[0]
    for s in same[1:]:
        condition &= s
    return source.join(t, condition, "left_anti")
