"""Physical conversions of surface fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Above it a temperature is in kelvin; below it an amount of rain is in metres; a low boundary layer.
KELVIN_ABOVE, METRES_BELOW, LOW_LAYER_M = 150.0, 10.0, 300.0


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def wind_direction(u: Column, v: Column) -> Column:
    """Degrees as (270 - angle of the vector) modulo 360."""
    return F.pmod(270.0 - F.degrees(F.atan2(v, u)), F.lit(360.0))


def celsius(t: Column) -> Column:
    return F.when(t > KELVIN_ABOVE, t - 273.15).otherwise(t)


def millimetres(x: Column) -> Column:
    return F.when(F.abs(x) < METRES_BELOW, x * 1000.0).otherwise(x)


def guarded_ratio(a: Column, b: Column) -> Column:
    """a / b, null where either is null or b is 0."""
    return F.try_divide(a, b)


def coverage_pct(observed: Column, expected: Column) -> Column:
    return F.round(observed / F.greatest(expected, F.lit(1)) * 100.0, 1)
