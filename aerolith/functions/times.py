"""Parsing of times and of names that hold times; what does not parse is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed format of a granule's file name: product, A + year + day of year, tile, collection.
GRANULE = r"^([A-Z0-9]+)\.A(\d{7})\.h(\d{2})v(\d{2})\.(\d{3})\.(\d+)\.hdf$"


def iso_time(raw: Column) -> Column:
    """ISO 8601 with or without Z, offset or fraction."""
    return F.try_to_timestamp(F.trim(raw))


def at_utc(wall: Column, zone: Column) -> Column:
    """The instant of a wall clock time in a zone; a null zone is UTC."""
    return F.to_utc_timestamp(wall, F.coalesce(zone, F.lit("UTC")))


def tile_name_parts(name: Column) -> dict[str, Column]:
    """Parts of a granule's name, null where it is none."""
    part = lambda i: F.nullif(F.regexp_extract(name, GRANULE, i), F.lit(""))
    return {
        "short_name": part(1),
        "acquisition_date": F.try_to_timestamp(part(2), F.lit("yyyyDDD")).cast("date"),
        "tile": F.when(part(3).isNotNull(), F.concat(F.lit("h"), part(3), F.lit("v"), part(4))),
        "collection": part(5),
    }


def dump_year(raw: Column) -> Column:
    """Two-digit years below 70 are of this century, others of the last; longer ones are whole."""
    year = F.expr("int(null)") if raw is None else raw.cast("int")
    return F.when(year >= 100, year).when(year >= 70, year + 1900).otherwise(year + 2000)
