"""Rebuilding what late rows change, and nothing else.

Rows carry the time of their event and the time at which they were ingested.  A stored mark tells up to which ingest time a table has seen its source.  The
hours of newer rows are dirty; an hour's features reach back by lags and rolling windows and forward by leads, so a dirty hour changes the features from
`ahead` hours before it to `back` hours after it.  Those are built anew from the source's rows within reach of them and merged into the
table; all other partitions are neither read nor written.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.shared import staged
from aerolith.sinks.upsert import upsert


@dataclass(frozen=True)
class Mark:
    """What a table has seen: ingest times up to `seen`, and hours from `low` to `high`."""

    seen: datetime
    low: datetime
    high: datetime

    def save(self, spark: SparkSession, path: str) -> None:
        line = json.dumps({k: getattr(self, k).isoformat() for k in ("seen", "low", "high")})
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Mark | None:
        """The latest mark below `path`, or None before the first; marks are appended, so a failed save leaves the one before."""
        try:
            got = spark.read.schema("seen string, low string, high string").json(path).agg(F.max(F.struct("seen", "low", "high")).alias("m")).first()["m"]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return got and Mark(*(datetime.fromisoformat(got[k]) for k in ("seen", "low", "high")))


@dataclass(frozen=True)
class Rebuilt:
    """What a rebuild did: rows that were new, hours that were built again, and the first and last hour of the table."""

    new_rows: int
    hours: int
    partitions: int
    mark: Mark | None


def ntz(t: datetime) -> Column:
    """A time without a zone as a literal, whatever the zones of Python and the session."""
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def around(hours: DataFrame, hour: str, back: int, ahead: int) -> DataFrame:
    """The distinct hours from `back` before each to `ahead` after it."""
    hour_of = lambda n: F.col(hour) + F.make_dt_interval(F.lit(0), F.lit(n))
    return hours.select(F.explode(F.sequence(hour_of(-back), hour_of(ahead), F.expr("interval 1 hour"))).alias(hour)).distinct()


def rebuild_late(source: DataFrame, path: str, state: str, hourly: Callable[[DataFrame], DataFrame], features: Callable[[DataFrame], DataFrame], event: str, ingest: str, back: int, ahead: int, partition: Column | None = None) -> Rebuilt:
    """Bring the table at `path` up to the rows of `source` that came after the mark kept at `state`.

    `hourly` makes rows of unique hours (column hour, TIMESTAMP_NTZ) of source rows, each from the rows of its hour alone; `features` adds columns to rows on a dense
    grid of hours, each from at most `back` hours before and `ahead` hours after.  The table gets `features`' columns and its partition (the day, if not given).
    It has every hour from the first to the last, as a full build has.  Ingest times must not fall: rows that arrive later have a greater one than the mark.
    Run again after a failure it does the same work, as the mark is saved last and the merge goes by hour.  Null event or ingest times are left out.  Nothing new changes nothing.
    """
    spark = source.sparkSession
    mark = Mark.load(spark, state)
    rows = source.where(F.col(event).isNotNull() & F.col(ingest).isNotNull())
    fresh = rows if mark is None else rows.where(F.col(ingest).cast("timestamp_ntz") > ntz(mark.seen))
    hour_of = F.date_trunc("hour", event).cast("timestamp_ntz")
    # One row for each hour that has new rows.
    dirty = staged(fresh.groupBy(hour_of.alias("hour")).agg(F.count("*").alias("n"), F.max(F.col(ingest).cast("timestamp_ntz")).alias("seen")), "dirty")
    found = dirty.agg(F.sum("n").alias("n"), F.max("seen").alias("seen"), F.min("hour").alias("low"), F.max("hour").alias("high")).first()
    if not found["n"]:
        return Rebuilt(0, 0, 0, mark)
    low, high = (found["low"], found["high"]) if mark is None else (min(found["low"], mark.low), max(found["high"], mark.high))
    hours = dirty.select("hour")
    if mark is not None:
        # The grid grows at its ends, by hours that need not have rows.
        grown = [(a, b) for a, b in ((low, mark.low - timedelta(hours=1)), (mark.high + timedelta(hours=1), high)) if a <= b]
        if grown:
            ends = spark.createDataFrame(grown, "a timestamp_ntz, b timestamp_ntz")
            hours = hours.unionByName(ends.select(F.explode(F.sequence("a", "b", F.expr("interval 1 hour"))).alias("hour"))).distinct()
        within = F.col("hour").between(ntz(low), ntz(high))
        changed = staged(around(hours, "hour", ahead, back).where(within), "changed")
        needed = staged(around(changed, "hour", back, ahead).where(within), "needed")
        edge = needed.agg(F.min("hour").alias("a"), F.max("hour").alias("b")).first()
        # Bounds reach the scan; the hours between are told by a join.
        time = F.col(event).cast("timestamp_ntz")
        near = rows.where((time >= ntz(edge["a"])) & (time < ntz(edge["b"] + timedelta(hours=1))))
        keyed = near.withColumn("__hour", hour_of)
        near = keyed.join(needed.select(F.col("hour").alias("__hour")), "__hour", "left_semi").drop("__hour")
        built = features(needed.join(hourly(near), "hour", "left")).join(changed, "hour", "left_semi")
    else:
        grid = spark.range(1).select(F.explode(F.sequence(ntz(low), ntz(high), F.expr("interval 1 hour"))).alias("hour"))
        built = features(grid.join(hourly(rows), "hour", "left"))
    built = staged(built.withColumn("part", F.col("hour").cast("date") if partition is None else partition), "built")
    count = built.agg(F.count("*").alias("n"), F.count_distinct("part").alias("parts")).first()
    upsert(built, path, ["hour"], ["part"])
    new = Mark(max(found["seen"], mark.seen) if mark else found["seen"], low, high)
    new.save(spark, state)
    return Rebuilt(found["n"], count["n"], count["parts"], new)
