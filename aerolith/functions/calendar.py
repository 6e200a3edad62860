"""Calendar features of a timestamp."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
RUSH_HOURS = (7, 8, 9, 17, 18, 19)
SEASONS = {"winter": (12, 1, 2), "spring": (3, 4, 5), "summer": (6, 7, 8)}


def season(month: Column) -> Column:
    out = F.lit("autumn")
    for name, months in SEASONS.items():
        out = F.when(month.isin(*months), name).otherwise(out)
    return out


def calendar_columns(ts: Column) -> dict[str, Column]:
    """Name -> column; weeks begin on Sunday, which is day 1."""
    hour, dow, month = F.hour(ts), F.dayofweek(ts), F.month(ts)
    out = {"hour_of_day": hour, "day_of_week": dow, "month": month, "season": season(month), "is_weekend": dow.isin(1, 7), "is_rush_hour": hour.isin(*RUSH_HOURS)}
    for name, value, period in (("hour", hour, 24.0), ("dow", dow, 7.0), ("month", month, 12.0)):
        angle = value * (2 * math.pi / period)
        out |= {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}
    return out
