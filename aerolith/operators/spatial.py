"""Neighbours and gradients in the plane of degrees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.config import BBox, Center
from aerolith.functions.geo import degrees_between, inverse_distance
from aerolith.operators.quality import finite, in_box
from aerolith.shared import staged


#: Pixels of a cell that is not cut any further, and how often a cell of the radius' width may be cut in four.
LEAF, DEPTH = 16, 6
#: Lanes that rows of one cell are dealt out to before its count is known.
LANES = 8


def _up(cell: str, level: Column | str, depth: int) -> Column:
    """The cell of a level that holds a cell of the last level (level 0 is as wide as the radius)."""
    return F.call_function("shiftright", F.col(cell), (F.lit(depth) - level).cast("int"))


def quadtree(cells: DataFrame, on: Sequence[str], leaf: int, depth: int) -> DataFrame:
    """Columns on, __l (level), __a, __b (cell), __n: the leaves of each group's tree, cut by the counts (on, __a, __b, __n) of cells of the last level.

    A cell is a leaf if it holds at most `leaf` pixels or is of the last level, and the cell around it is no leaf.
    """
    levels = cells.select(*on, F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("__l"), "__a", "__b", "__n")
    counts = levels.groupBy(*on, "__l", _up("__a", F.col("__l"), depth).alias("__a"), _up("__b", F.col("__l"), depth).alias("__b")).agg(F.sum("__n").alias("__n"))
    # A cell and its three neighbours in the cell around them.
    around = F.sum("__n").over(Window.partitionBy(*on, "__l", F.shiftright("__a", 1), F.shiftright("__b", 1)))
    whole = (F.col("__n") <= leaf) | (F.col("__l") == depth)
    return counts.withColumn("__around", around).where(whole & ((F.col("__l") == 0) | (F.col("__around") > leaf))).drop("__around")


def nearest_within(points: DataFrame, pixels: DataFrame, lat: str, lon: str, pixel_lat: str, pixel_lon: str, on: Sequence[str], radius: float, values: Sequence[str], key: Sequence[str], leaf: int = LEAF, depth: int = DEPTH) -> DataFrame:
    """For each distinct (key, place) of `points` and each group of `on`, the nearest pixel within the radius.

    Cells as wide as the radius are cut in four, and again, where a group has more than `leaf` pixels.  A point asks the leaf that it stands in; the distance that it finds there
    (the radius, if none) is the reach of its second question, to the other leaves within it.  So a point sees a few leaves however dense its
    surroundings are.  A leaf of the last level that still holds more is dealt out in lanes of about `leaf` pixels.  Points and pixels are staged and read once.  Of the
    pixels of one place and group only the smallest values are kept, and points of one place ask once, whatever their keys.  Equal
    distances go to the smallest pixel place, then values.  Null places and those that are not finite have no neighbour; null groups match nothing.
    Columns: key, place of the point, on, dist_deg, values; points without a pixel are left out.
    """
    shared = [c for c in on if c in points.columns]
    width = radius / 2**depth
    cell = lambda c: F.floor(F.col(c) / width).cast("long")
    held = pixels.select(*on, F.col(pixel_lat).cast("double").alias("__lat"), F.col(pixel_lon).cast("double").alias("__lon"), *values).where(finite(F.col("__lat")) & finite(F.col("__lon")))
    held = held.groupBy(*on, "__lat", "__lon").agg(F.min(F.struct(*values)).alias("__least")).select(*on, "__lat", "__lon", "__least.*") if values else held.distinct()
    lane = F.pmod(F.xxhash64("__lat", "__lon", *values, F.monotonically_increasing_id()), F.lit(LANES)).cast("int")
    held = staged(held.withColumns({"__i": cell("__lat"), "__j": cell("__lon"), "__lane": lane}), "pixels")
    asks = staged(points.select(*key, lat, lon, *shared).where(finite(F.col(lat)) & finite(F.col(lon))).distinct(), "asks")
    places = asks.select(lat, lon, *shared).distinct()
    if len(shared) < len(on):
        if not shared:
            raise ValueError(f"points must have one of the columns {', '.join(on)}")
        places = places.join(held.select(*on).distinct(), shared)
    target = list(dict.fromkeys([*key, lat, lon, *on]))
    places = places.withColumns({"__i": cell(lat), "__j": cell(lon)})
    places = staged(places.withColumn("__id", F.monotonically_increasing_id()), "places")

    # Counts by lane, so that a cell with most of the pixels is no hot key, here and in the join that tells pixels their leaf.
    lanes = staged(held.groupBy(*on, "__i", "__j", "__lane").agg(F.count("*").alias("__n")), "lanes")
    leaves = staged(quadtree(lanes.select(*on, F.col("__i").alias("__a"), F.col("__j").alias("__b"), "__n"), on, leaf, depth), "leaves")
    levels = F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("__l")
    at_levels = lambda df, *columns: df.select(*columns, "__i", "__j", levels).withColumns({"__a": _up("__i", F.col("__l"), depth), "__b": _up("__j", F.col("__l"), depth)})
    place = [*on, "__l", "__a", "__b"]
    cells = at_levels(lanes, *on, "__lane").join(leaves, place)
    parts = F.greatest(F.ceil(F.col("__n") / leaf), F.lit(1)).cast("int")
    stored = held.join(cells.select(*on, "__i", "__j", "__lane", "__l", "__a", "__b", parts.alias("__parts")), [*on, "__i", "__j", "__lane"])
    part = F.pmod(F.xxhash64("__lat", "__lon", *values, F.lit(1)), F.col("__parts"))
    stored = staged(stored.select(*place, part.cast("int").alias("__part"), "__lat", "__lon", *values), "stored")

    def best(asked: DataFrame) -> DataFrame:
        """The best pixel of the leaves that are asked: `__id`, place of the leaf, its count n, and the point."""
        each = asked.withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1)))
        near = each.join(stored, [*place, "__part"])
        near = near.withColumn("dist_deg", degrees_between(F.col("__y"), F.col("__x"), F.col("__lat"), F.col("__lon"))).where(F.col("dist_deg") <= radius)
        found = near.groupBy("__id").agg(F.min(F.struct("dist_deg", "__lat", "__lon", *values)).alias("__best"), F.first(F.struct("__l", "__a", "__b")).alias("__leaf"))
        return found.select("__id", "__best", "__leaf")

    named = places.select("__id", *on, F.col(lat).cast("double").alias("__y"), F.col(lon).cast("double").alias("__x"), "__i", "__j")
    first = staged(best(at_levels(named, "__id", *on, "__y", "__x").join(leaves, place)), "first")

    # The second question: the cells of a level at least twice as wide as the reach, four at most, and the leaves in them or around them.
    reach = F.coalesce("__best.dist_deg", F.lit(float(radius))) * (1 + 1e-9) + 1e-12
    side = F.lit(width) * F.pow(F.lit(2.0), F.lit(depth) - F.col("__l"))
    asked = named.join(first, "__id", "left").withColumn("__reach", reach)
    # Whose reach ends within the leaf that was asked is done.
    leaf_side = F.lit(width) * F.pow(F.lit(2.0), F.lit(depth) - F.col("__leaf.__l"))
    within = lambda c, k: (F.col(c) - F.col(f"__leaf.{k}") * leaf_side > F.col("__reach")) & ((F.col(f"__leaf.{k}") + 1) * leaf_side - F.col(c) > F.col("__reach"))
    asked = asked.where(~F.coalesce(within("__y", "__a") & within("__x", "__b"), F.lit(False)))
    wide = F.greatest(F.lit(0), F.least(F.lit(depth), F.floor(F.log2(F.lit(float(radius)) / (2 * F.col("__reach")))).cast("int")))
    asked = asked.withColumn("__wide", wide)
    span = lambda c: F.sequence(*(_floor_at(F.col(c) + s * F.col("__reach"), width, F.col("__wide"), depth) for s in (-1, 1)))
    asked = asked.withColumn("__ci", F.explode(span("__y"))).withColumn("__cj", F.explode(span("__x")))
    below = leaves.select(*place, "__n", F.explode(F.sequence(F.lit(0), "__l")).alias("__wide"))
    step = lambda c, to: F.call_function("shiftright", F.col(c), (F.col("__l") - to).cast("int"))
    below = below.withColumns({"__ci": step("__a", F.col("__wide")), "__cj": step("__b", F.col("__wide"))})
    inner = asked.join(below, [*on, "__wide", "__ci", "__cj"])
    outer = asked.where("__wide > 0").withColumn("__l", F.explode(F.sequence(F.lit(0), F.col("__wide") - 1)))
    up = lambda c: F.call_function("shiftright", F.col(c), (F.col("__wide") - F.col("__l")).cast("int"))
    outer = outer.withColumns({"__a": up("__ci"), "__b": up("__cj")}).join(leaves, place)
    columns = ["__id", *place, "__n", "__y", "__x", "__reach"]
    more = inner.select(*columns).unionByName(outer.select(*columns)).distinct()
    gap = lambda c, k: F.greatest(F.lit(0.0), F.col(k) * side - F.col(c), F.col(c) - (F.col(k) + 1) * side)
    own = (_floor_at(F.col("__y"), width, F.col("__l"), depth) == F.col("__a")) & (_floor_at(F.col("__x"), width, F.col("__l"), depth) == F.col("__b"))
    near = (gap("__y", "__a") <= F.col("__reach")) & (gap("__x", "__b") <= F.col("__reach"))
    second = best(more.where(near & ~own))
    found = first.select("__id", "__best").unionByName(second.select("__id", "__best")).groupBy("__id").agg(F.min("__best").alias("__best"))
    met = places.select("__id", lat, lon, *on).join(found, "__id").drop("__id")
    return asks.join(met, list(dict.fromkeys([lat, lon, *shared]))).select(*target, "__best.dist_deg", *(f"__best.{v}" for v in values))


def _floor_at(x: Column, width: float, level: Column, depth: int) -> Column:
    """The number of the cell of a level that a coordinate lies in; through the last level, as the tree's cells are."""
    return F.call_function("shiftright", F.floor(x / width).cast("long"), (F.lit(depth) - level).cast("int"))


def idw_gradient(df: DataFrame, group: str, lat: str, lon: str, value: str, station: str, sensor: str, center: Center = Center(), offset: float = 0.25, k: int = 3, least: int = 3) -> DataFrame:
    """Inverse-distance means north, south, east and west of the centre, by group, from the k nearest readings.

    Columns: group, grad_n, grad_s, grad_e, grad_w, spatial_std (sample), grad_mag; all null with fewer than `least`
    stations.  Equal distances go to the smaller station, then sensor.  Only k readings a side are kept per task.
    """
    sides = {"n": (center.lat + offset, center.lon), "s": (center.lat - offset, center.lon), "e": (center.lat, center.lon + offset), "w": (center.lat, center.lon - offset)}
    rows = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull() & F.col(value).isNotNull())
    whole = rows.groupBy(group).agg(F.count_distinct(station).alias("__n"), F.stddev_samp(value).alias("spatial_std"))
    targets = F.explode(F.array(*(F.struct(F.lit(name).alias("side"), F.lit(y).alias("y"), F.lit(x).alias("x")) for name, (y, x) in sides.items())))
    asked = rows.select(group, lat, lon, value, station, sensor, targets.alias("__t")).select("*", degrees_between(F.col(lat), F.col(lon), F.col("__t.y"), F.col("__t.x")).alias("__d"))
    place = F.row_number().over(Window.partitionBy(group, "__t.side").orderBy("__d", station, sensor))
    means = asked.withColumn("__side", F.col("__t.side")).withColumn("__place", place).where(F.col("__place") <= k).groupBy(group, "__side").agg(inverse_distance(F.col(value), F.col("__d")).alias("__m"))
    wide = means.groupBy(group).agg(*(F.max(F.when(F.col("__side") == s, F.col("__m"))).alias(f"grad_{s}") for s in sides))
    enough = F.col("__n") >= least
    names = [f"grad_{s}" for s in sides]
    out = whole.join(wide, group).select(group, *(F.when(enough, F.col(c)).alias(c) for c in [*names, "spatial_std"]))
    ns, ew = F.col("grad_n") - F.col("grad_s"), F.col("grad_e") - F.col("grad_w")
    return out.withColumn("grad_mag", F.sqrt(ns * ns + ew * ew))


def grid_means(cells: DataFrame, group: Sequence[str], lat: str, lon: str, values: Sequence[str], box: BBox = BBox(), center: Center = Center()) -> DataFrame:
    """By group, means of finite values over the cells in the box, or the values of the nearest cell if none is in it.

    Columns: group, values, grid_point_count (1 for a nearest cell).
    """
    inside = in_box(F.col(lat), F.col(lon), box)
    mean = lambda v: F.avg(F.when(inside & finite(F.col(v)), F.col(v)))
    distance = degrees_between(F.col(lat), F.col(lon), F.lit(center.lat), F.lit(center.lon))
    nearest = F.min_by(F.struct(*values), F.struct(distance, lat, lon)).alias("__nearest")
    out = cells.groupBy(*group).agg(F.count_if(inside).alias("__n"), nearest, *(mean(v).alias(v) for v in values))
    return out.select(*group, *(F.when(F.col("__n") > 0, F.col(v)).otherwise(F.when(finite(F.col(f"__nearest.{v}")), F.col(f"__nearest.{v}"))).alias(v) for v in values), F.greatest("__n", F.lit(1)).alias("grid_point_count"))


def plume_grid(points: DataFrame, age: str, lat: str, lon: str, step: float = 0.1) -> DataFrame:
    """Share of an age's points in each cell of a grid, by rounding to the step."""
    bins = points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).groupBy(age, F.round(F.col(lat) / step).cast("int").alias("lat_bin"), F.round(F.col(lon) / step).cast("int").alias("lon_bin")).agg(F.count("*").alias("n"))
    totals = bins.groupBy(age).agg(F.sum("n").alias("total"))
    return bins.join(totals, bins[age].eqNullSafe(totals[age])).drop(totals[age]).withColumn("probability", F.col("n") / F.col("total"))


def in_polygon(lat: Column, lon: Column, ring: Sequence[tuple[float, float]]) -> Column:
    """Whether a place lies in a polygon of (lat, lon) corners, by crossings; edges count as either side."""
    crossings = F.lit(0)
    for (y1, x1), (y2, x2) in zip(ring, [*ring[1:], ring[0]], strict=True):
        if y1 == y2:
            continue
        spans = (F.lit(y1) > lat) != (F.lit(y2) > lat)
        right = lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1
        crossings = crossings + F.when(spans & right, 1).otherwise(0)
    return F.pmod(crossings, F.lit(2)) == 1
