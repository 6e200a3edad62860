"""Plane geometry in degrees, and the sinusoidal tile grid."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the sinusoidal grid: radius in metres, tiles across and down.
RADIUS, TILES_ACROSS, TILES_DOWN = 6371007.181, 36, 18


def degrees_between(lat: Column, lon: Column, lat2: Column, lon2: Column) -> Column:
    return F.sqrt((lat - lat2) * (lat - lat2) + (lon - lon2) * (lon - lon2))


def inverse_distance(value: Column, distance: Column) -> Column:
    """Aggregate: inverse-distance weighted mean, distances of at least a millionth of a degree."""
    d = F.greatest(distance, F.lit(1e-6))
    return F.sum(value / d) / F.sum(1.0 / d)


def sinusoidal_tile(h: Column, v: Column, row: Column, col: Column, size: int) -> tuple[Column, Column]:
    """Latitude and longitude of a pixel's centre in tile (h, v) of size x size pixels."""
    tile = 2 * math.pi * RADIUS / TILES_ACROSS
    x = (h - TILES_ACROSS // 2) * tile + (col + 0.5) * (tile / size)
    y = (TILES_DOWN // 2 - v) * tile - (row + 0.5) * (tile / size)
    lat = y / RADIUS
    return F.degrees(lat), F.degrees(x / (RADIUS * F.cos(lat)))
