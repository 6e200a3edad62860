"""As-of joins without a theta join.

Observations and probes are put on one time line, where an observation stands at the time from which it may be used.
Within a day the last observation runs forward by a window; across days the last observation of each day is
carried by a window over one row per key and day.  No task holds more than a key's day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable_from(day: Column, available: Column | None = None) -> Column:
    """The day after, or the availability on the observation's own day if that is known and earlier."""
    following = F.date_add(day, 1).cast("timestamp_ntz")
    if available is None:
        return following
    available = available.cast("timestamp_ntz")
    return F.when(available.isNotNull(), F.least(F.greatest(available, day.cast("timestamp_ntz")), following)).otherwise(following)


def asof_join(probes: DataFrame, observations: DataFrame, probe_ts: str, day: str, available: str | None, values: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """`probes` with the values of the newest observation that may be used: newest day, then latest availability.

    Ties go to the greatest values.  Probes come once each; those without an observation get nulls.
    """
    order = [c for c in (day, available) if c]
    seen = F.struct(*order, *(v for v in values if v not in order)).alias("__seen")
    obs = observations.where(F.col(day).isNotNull()).select(*by, usable_from(F.col(day), F.col(available) if available else None).alias("__at"), F.lit(0).alias("__kind"), seen, F.lit(None).cast(probes.select(F.struct("*").alias("p")).schema["p"].dataType).alias("__probe"))
    rows = probes.select(*by, F.col(probe_ts).cast("timestamp_ntz").alias("__at"), F.lit(1).alias("__kind"), F.lit(None).cast(obs.schema["__seen"].dataType).alias("__seen"), F.struct("*").alias("__probe"))
    line = obs.unionByName(rows).withColumn("__day", F.col("__at").cast("date"))
    today = Window.partitionBy(*by, "__day").orderBy("__at", "__kind").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*by).orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    days = line.groupBy(*by, "__day").agg(F.max("__seen").alias("__last")).select(*by, "__day", F.max("__last").over(before).alias("__carried"))
    found = line.withColumn("__running", F.max("__seen").over(today)).where("__kind = 1")
    keys = [found[c].eqNullSafe(days[c]) for c in [*by, "__day"]]
    condition = keys[0]
    for k in keys[1:]:
        condition &= k
    joined = found.join(days, condition, "left").select(found["__probe"], _later("__running", "__carried").alias("__best"))
    return joined.select("__probe.*", *(F.col(f"__best.{v}").alias(v) for v in values))


def _later(a: str, b: str) -> Column:
    """The greater of two structs, either of which may be null."""
    return F.array_max(F.filter(F.array(a, b), lambda x: x.isNotNull()))
