"""Column functions: names, times, physical units, geometry."""

from aerolith.functions.calendar import calendar_columns, season
from aerolith.functions.geo import degrees_between, inverse_distance, sinusoidal_tile
from aerolith.functions.text import alias_product, first_link, label_of, normalized_name, run_id, safe_id
from aerolith.functions.times import at_utc, iso_time, tile_name_parts
from aerolith.functions.units import celsius, coverage_pct, guarded_ratio, millimetres, wind_direction, wind_speed

__all__ = [
    "alias_product",
    "at_utc",
    "calendar_columns",
    "celsius",
    "coverage_pct",
    "degrees_between",
    "first_link",
    "guarded_ratio",
    "inverse_distance",
    "iso_time",
    "label_of",
    "millimetres",
    "normalized_name",
    "run_id",
    "safe_id",
    "season",
    "sinusoidal_tile",
    "tile_name_parts",
    "wind_direction",
    "wind_speed",
]
