"""Points in many polygons, by covers of cells.

A polygon is covered by cells of a grid that is cut in four, again and again: a cell that no edge crosses is inside or outside as a whole, and one that an edge
crosses is cut further, down to a last level.  Points meet cells by equal numbers of cells.  In an inner cell a point is inside without any further
look; in an edge cell of the last level it is tested against the edges that share the cell's band of latitudes, the only ones that its ray can cross.
Rings may nest in any way: a point is inside where its ray crosses an odd number of edges, so a ring inside another is a hole.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from aerolith.shared import staged

#: Rings of a polygon: arrays of corners, the last joined with the first.
RINGS = "array<array<struct<lat: double, lon: double>>>"
EDGES = ArrayType(ArrayType(DoubleType()))
#: Cells times edges of a row that are looked at together.
AT_ONCE = 1 << 16


def edges_of(rings: list) -> np.ndarray:
    """Edges (y1, x1, y2, x2) of all rings; level ones are left out, as no ray crosses them.  A ring that holds a null corner or one that is not finite has no edges."""
    out = []
    for ring in rings or []:
        corners = [(c["lat"], c["lon"]) for c in ring or [] if c is not None]
        if len(corners) < 3 or len(corners) < len(ring) or not all(v is not None and np.isfinite(v) for c in corners for v in c):
            continue
        out += [(*a, *b) for a, b in zip(corners, [*corners[1:], corners[0]], strict=True) if a[0] != b[0]]
    return np.array(out, float).reshape(-1, 4)


def crossings(edges: np.ndarray, lat: float, lon: np.ndarray) -> np.ndarray:
    """Edges that the rays from places of one latitude to the east cross; an edge counts from its lower end up to, but without, its upper end."""
    y1, x1, y2, x2 = edges.T
    spans = (y1 > lat) != (y2 > lat)
    return (spans & (lon[:, None] < (x2 - x1) * (lat - y1) / (y2 - y1) + x1)).sum(1)


def touched(edges: np.ndarray, low: float, left: np.ndarray, side: float) -> np.ndarray:
    """For closed squares of one row, which edges may meet each: boxes overlap, and the square's corners are not all strictly on one side of the edge."""
    y1, x1, y2, x2 = edges.T
    left = left[:, None]
    high, right = low + side, left + side
    box = (np.minimum(y1, y2) <= high) & (np.maximum(y1, y2) >= low) & (np.minimum(x1, x2) <= right) & (np.maximum(x1, x2) >= left)
    signs = np.stack([(x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) for y in (low, high) for x in (left, right)])
    slack = 1e-9 * (np.abs(x2 - x1) + np.abs(y2 - y1)) * side
    return box & ~((signs > slack).all(0) | (signs < -slack).all(0))


def cover(edges: np.ndarray, side: float, depth: int) -> Iterator[tuple[int, int, int, np.ndarray | None]]:
    """Cells (level, i, j) that the polygon covers, `side` wide at level 0: inner ones with None, edge cells of the last level with the edges of their band."""
    if not len(edges):
        return
    y, x = edges[:, [0, 2]], edges[:, [1, 3]]
    first = np.arange(int(np.floor(x.min() / side)), int(np.floor(x.max() / side)) + 1)
    todo = [(0, i, first, edges) for i in range(int(np.floor(y.min() / side)), int(np.floor(y.max() / side)) + 1)]
    while todo:
        level, i, j, band = todo.pop()
        width = side / 2**level
        low = i * width
        # Only these edges can be crossed by a ray from the row, which a hair more than its band makes sure of.
        band = band[(np.minimum(band[:, 0], band[:, 2]) <= low + width * (1 + 1e-9)) & (np.maximum(band[:, 0], band[:, 2]) >= low - width * 1e-9)]
        many = max(1, AT_ONCE // max(1, len(band)))
        if len(j) > many:
            todo += [(level, i, j[at : at + many], band) for at in range(0, len(j), many)]
            continue
        left = j * width
        edge = touched(band, low - width * 1e-9, left - width * 1e-9, width * (1 + 2e-9)).any(1)
        for n in j[~edge & (crossings(band, low + width / 2, left + width / 2) % 2 == 1)].tolist():
            yield level, i, n, None
        if level == depth:
            for n in j[edge].tolist():
                yield level, i, n, band
        elif edge.any():
            below = (2 * j[edge][:, None] + np.arange(2)).ravel()
            todo += [(level + 1, 2 * i + a, below, band) for a in (0, 1)]


def covers(polygons: DataFrame, key: Sequence[str], rings: str, side: float, depth: int, lanes: int) -> DataFrame:
    """Columns key, __l, __i, __j, __lane, __edges: the cover of each polygon, once a lane; __edges is null in inner cells."""
    names = [f"__key{n}" for n in range(len(key))]
    rows = polygons.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(key, names, strict=True)), F.col(f"`{rings}`").cast(RINGS).alias("__rings"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, shape in enumerate(batch.column("__rings").to_pylist()):
                held: list[tuple] = []
                for cell in cover(edges_of(shape), side, depth):
                    held.append(cell)
                    if len(held) == 1024:
                        yield made(batch, at, held)
                        held = []
                if held:
                    yield made(batch, at, held)

    def made(batch: pa.RecordBatch, at: int, cells: list[tuple]) -> pa.RecordBatch:
        whole = [batch.column(n).take(pa.array([at] * len(cells))) for n in names]
        level, i, j, edges = zip(*cells, strict=True)
        lists = pa.array([None if e is None else e.tolist() for e in edges], pa.list_(pa.list_(pa.float64())))
        return pa.RecordBatch.from_arrays([*whole, pa.array(level, pa.int32()), pa.array(i, pa.int64()), pa.array(j, pa.int64()), lists], [*names, "__l", "__i", "__j", "__edges"])

    shape = StructType([*rows.schema.fields[: len(names)], StructField("__l", IntegerType()), StructField("__i", LongType()), StructField("__j", LongType()), StructField("__edges", EDGES)])
    found = rows.mapInArrow(run, shape)
    lane = F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("__lane")
    return found.select(*(F.col(n).alias(c) for c, n in zip(key, names, strict=True)), "__l", "__i", "__j", lane, "__edges")


def points_in_polygons(points: DataFrame, polygons: DataFrame, lat: str, lon: str, key: Sequence[str], rings: str, side: float = 1.0, depth: int = 5, lanes: int = 4) -> DataFrame:
    """`points` with `key` of each polygon that holds them, a row for each such pair.

    `rings` holds arrays of corners (lat, lon); a place inside an odd number of rings is inside.  The rule for edges and corners is that of the ray: the southern and western
    ones are inside, but for shapes that touch themselves.  Cells are `side` degrees wide at first and cut `depth` times.  Points of one cell are dealt out in
    `lanes`, each of which has its copy of the covers, which are small beside the points.  Places that are null or not finite are in no polygon, nor is anything in
    polygons without a ring of three corners; repeated rows are rows like any other.  Polygons do not wrap around the date line.
    """
    fine = side / 2**depth
    at = lambda c: F.floor(F.col(f"`{c}`") / F.lit(fine)).cast("long")
    ok = lambda c: F.coalesce(F.abs(F.col(f"`{c}`")) < float("inf"), F.lit(False))
    rows = points.where(ok(lat) & ok(lon)).select(F.struct(*(F.col(f"`{c}`") for c in points.columns)).alias("__row"), F.col(f"`{lat}`").cast("double").alias("__y"), F.col(f"`{lon}`").cast("double").alias("__x"), at(lat).alias("__fi"), at(lon).alias("__fj"))
    rows = rows.withColumn("__lane", F.pmod(F.xxhash64("__y", "__x", F.monotonically_increasing_id()), F.lit(lanes)).cast("int"))
    levels = rows.withColumn("__l", F.explode(F.sequence(F.lit(0), F.lit(depth))))
    up = lambda c: F.call_function("shiftright", F.col(c), (F.lit(depth) - F.col("__l")).cast("int"))
    met = levels.withColumns({"__i": up("__fi"), "__j": up("__fj")}).join(covers(polygons, key, rings, side, depth, lanes), ["__l", "__i", "__j", "__lane"])
    y, x = F.col("__y"), F.col("__x")
    crossed = lambda e: ((e[0] > y) != (e[2] > y)) & (x < (e[3] - e[1]) * (y - e[0]) / (e[2] - e[0]) + e[1])
    inside = F.col("__edges").isNull() | (F.size(F.filter("__edges", crossed)) % 2 == 1)
    return met.where(inside).select("__row.*", *key)


def counts_in_polygons(points: DataFrame, polygons: DataFrame, lat: str, lon: str, key: Sequence[str], rings: str, out: str = "n", side: float = 1.0, depth: int = 5, lanes: int = 4) -> DataFrame:
    """Columns key and `out`: how many rows of `points` each polygon holds, by the rules of `points_in_polygons`; polygons that hold none are left out.

    Points of one place are one row with their count, and polygons of equal rings one shape, which is covered and tested once: work goes with the different places and
    shapes, not with the rows that share them.  A key that several polygons have counts the points of each.
    """
    names = [f"__key{n}" for n in range(len(key))]
    owners = polygons.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(key, names, strict=True)), F.col(f"`{rings}`").cast(RINGS).alias("__shape"))
    # Staged, as numbers that are computed twice would differ.
    shapes = staged(owners.select("__shape").distinct().withColumn("__id", F.monotonically_increasing_id()), "shapes")
    # A few shapes are small in bytes but long in work.
    spread = shapes.repartition(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), "__id")
    places = points.groupBy(F.col(f"`{lat}`").alias("__lat"), F.col(f"`{lon}`").alias("__lon")).agg(F.count("*").alias("__n"))
    held = points_in_polygons(places, spread, "__lat", "__lon", ["__id"], "__shape", side, depth, lanes).groupBy("__id").agg(F.sum("__n").alias("__n"))
    found = owners.join(shapes.join(held, "__id"), "__shape").groupBy(*names).agg(F.sum("__n").alias(out))
    return found.select(*(F.col(n).alias(c) for c, n in zip(key, names, strict=True)), out)
