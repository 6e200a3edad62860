"""Nearest pixels by adaptive cells, points in polygons, and global ranks."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.operators import polygons as polygons_module, spatial
from aerolith.operators.polygons import RINGS, counts_in_polygons, cover, edges_of, points_in_polygons
from aerolith.operators.series import ranked, time_split
from aerolith.operators.spatial import nearest_within, quadtree


def brute_nearest(points, pixels, radius):
    out = {}
    for i, y, x, g in points:
        near = [(math.sqrt((y - a) ** 2 + (x - b) ** 2), a, b, v) for h, a, b, v in pixels if h == g and None not in (a, b, x, y)]
        near = [n for n in near if n[0] <= radius]
        if near:
            out[(i, g)] = min(near)
    return out


@pytest.mark.parametrize("spread", [3.0, 0.02, 0.0])
def test_nearest_equals_brute_force(spark, spread):
    """Pixels far apart, in one small cell, and all in one place; points in it, beside it, and far off."""
    rng = random.Random(spread)
    pixels = [(g, 21 + spread * rng.random(), 105 + spread * rng.random(), float(rng.randrange(50))) for g in ("a", "b") for _ in range(400)] + [("a", None, 1.0, 1.0), ("a", float("nan"), 1.0, 1.0), ("c", -0.3, -0.2, 9.0)]
    points = [(i, 21 + spread * rng.random() * 1.2, 105 + rng.choice([-0.3, 0.2, 0.001]) + spread * rng.random(), rng.choice("ab")) for i in range(80)] + [(90, 21.4, 105.4, "a"), (91, None, 2.0, "a"), (92, 40.0, 40.0, "b"), (93, 0.1, 0.1, "c"), (93, 0.1, 0.1, "c")]
    p, x = spark.createDataFrame(points, "i int, lat double, lon double, g string"), spark.createDataFrame(pixels, "g string, y double, x double, v double")
    got = nearest_within(p, x, "lat", "lon", "y", "x", ["g"], 0.5, ["v"], ["i"], leaf=8, depth=5).collect()
    want = brute_nearest(points, pixels, 0.5)
    assert {(r["i"], r["g"]): (round(r["dist_deg"], 12), r["v"]) for r in got} == {k: (round(d, 12), v) for k, (d, _, _, v) in want.items()}
    assert len(got) == len(want)
    assert nearest_within(p.limit(0), x, "lat", "lon", "y", "x", ["g"], 0.5, ["v"], ["i"]).count() == 0 == nearest_within(p, x.limit(0), "lat", "lon", "y", "x", ["g"], 0.5, ["v"], ["i"]).count()


def test_places_ask_once_and_keep_one_pixel(spark, monkeypatch):
    """Many keys and pixels of few places: a place is one question and one pixel with its smallest values, and every key gets its answer."""
    points = [(i, 21.0 + i % 3 * 0.1, 105.0) for i in range(300)]
    pixels = [(g, 21.01 + i % 2 * 0.1, 105.0, None if g == "b" and i == 7 else float(i % 50)) for i in range(200) for g in "ab"]
    p, x = spark.createDataFrame(points, "i int, lat double, lon double").withColumn("d", F.lit(1)), spark.createDataFrame(pixels, "g string, y double, x double, v double").withColumn("d", F.lit(1))
    sizes, whole = {}, spatial.staged
    monkeypatch.setattr(spatial, "staged", lambda df, name: sizes.setdefault(name, whole(df, name)))
    got = {(r["i"], r["g"]): (round(r["dist_deg"], 9), r["v"]) for r in nearest_within(p, x, "lat", "lon", "y", "x", ["d", "g"], 0.5, ["v"], ["i"]).collect()}
    least = {("a", 0): 0.0, ("a", 1): 1.0, ("b", 0): 0.0, ("b", 1): None}
    assert got == {(i, g): ((0.01, 0.01, 0.09)[i % 3], least[g, (0, 1, 1)[i % 3]]) for i in range(300) for g in "ab"}
    assert sizes["pixels"].count() == 4 and sizes["places"].count() == 6


def test_leaves_hold_few_pixels(spark):
    rng = np.random.default_rng(2)
    xy = np.concatenate([rng.integers(0, 64, (500, 2)), np.full((900, 2), 13), rng.integers(8, 10, (500, 2))])
    cells = spark.createDataFrame([("d", int(a), int(b), 1) for a, b in xy], "d string, __a long, __b long, __n long").groupBy("d", "__a", "__b").agg(F.sum("__n").alias("__n"))
    leaves = quadtree(cells, ["d"], 20, 6).collect()
    assert sum(r["__n"] for r in leaves) == len(xy)
    assert all(r["__n"] <= 20 or r["__l"] == 6 for r in leaves)
    covered = {}
    for r in leaves:
        step = 1 << (6 - r["__l"])
        for a in range(r["__a"] * step, (r["__a"] + 1) * step):
            for b in range(r["__b"] * step, (r["__b"] + 1) * step):
                assert covered.setdefault((a, b), r) is r
    assert {tuple(v) for v in xy.tolist()} <= set(covered)


SQUARE, HOLE = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0)], [(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0)]


def inside(rings, y, x):
    hit = 0
    for ring in rings:
        for (y1, x1), (y2, x2) in zip(ring, [*ring[1:], ring[0]], strict=True):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                hit += 1
    return hit % 2 == 1


def as_rings(rings):
    return [[{"lat": a, "lon": b} for a, b in ring] for ring in rings]


def test_polygons_equal_ray_casting(spark):
    rng = random.Random(5)
    shapes = {1: [SQUARE, HOLE], 2: [[(a - 10, b * 2 - 3) for a, b in SQUARE]], 3: [[(math.sin(t) * (2 + t % 1), math.cos(t) * (3 - t % 2)) for t in np.linspace(0, 6.2, 40).tolist()]], 4: [[(0.5, 0.5), (0.5001, 0.5), (0.5, 0.5001)]], 5: [], 6: [[(0.0, 0.0), (1.0, 1.0)]]}
    points = [(i, rng.choice([rng.uniform(-11, 6), float(rng.randrange(-2, 5))]), rng.choice([rng.uniform(-6, 6), float(rng.randrange(-2, 5))])) for i in range(1500)]
    points += [(2000, None, 1.0), (2001, float("nan"), 1.0), (2002, float("inf"), 1.0), (2003, 0.50002, 0.50002), (2003, 0.50002, 0.50002)]
    want = sorted((i, k) for i, y, x in points if y is not None and math.isfinite(y) for k, rings in shapes.items() if k < 5 and inside(rings, y, x))
    polygons = spark.createDataFrame([(k, as_rings(r)) for k, r in shapes.items()] + [(7, None), (8, [[{"lat": None, "lon": 1.0}, {"lat": 2.0, "lon": 1.0}, {"lat": 3.0, "lon": 9.0}]])], f"k int, rings {RINGS}")
    got = points_in_polygons(spark.createDataFrame(points, "i int, y double, x double"), polygons, "y", "x", ["k"], "rings", side=1.0, depth=4)
    assert sorted((r["i"], r["k"]) for r in got.collect()) == want
    assert points_in_polygons(spark.createDataFrame(points, "i int, y double, x double").limit(0), polygons, "y", "x", ["k"], "rings").count() == 0


def test_counts_in_polygons_cover_each_shape_once(spark, monkeypatch):
    """Many points of few places, and many polygons of few shapes: places and shapes meet, and their counts are those of the pairs."""
    places = [(0.5, 0.5), (2.0, 2.0), (3.5, 3.5), (9.0, 9.0), (None, 1.0), (float("nan"), 1.0)]
    points = spark.createDataFrame([(i, *places[i % 6]) for i in range(600)], "i int, y double, x double")
    shapes = [[SQUARE, HOLE], [HOLE], [], None]
    polygons = spark.createDataFrame([(k, None if shapes[k % 4] is None else as_rings(shapes[k % 4])) for k in range(40)] + [(0, as_rings([HOLE])), (None, as_rings([HOLE]))], f"k int, rings {RINGS}")
    seen = []
    whole = polygons_module.covers
    monkeypatch.setattr(polygons_module, "covers", lambda shapes, *rest: seen.append(shapes.count()) or whole(shapes, *rest))
    got = {r["k"]: r["n"] for r in counts_in_polygons(points, polygons, "y", "x", ["k"], "rings", side=1.0, depth=3).collect()}
    want = {}
    for r in points_in_polygons(points, polygons, "y", "x", ["k"], "rings", side=1.0, depth=3).collect():
        want[r["k"]] = want.get(r["k"], 0) + 1
    assert got == want and got[0] == 300 and got[1] == 100 and len(got) == 21
    assert seen[0] == 4
    assert counts_in_polygons(points.limit(0), polygons, "y", "x", ["k"], "rings").count() == 0 == counts_in_polygons(points, polygons.limit(0), "y", "x", ["k"], "rings").count()


def test_inner_cells_need_no_crossings():
    cells = list(cover(edges_of(as_rings([SQUARE, HOLE])), 1.0, 5))
    inner = [c for c in cells if c[3] is None]
    area = sum(4.0 ** -c[0] for c in inner)
    assert 9 < area < 12 and all(not (1 < (i + 0.5) / 2**level < 3 and 1 < (j + 0.5) / 2**level < 3) for level, i, j, _ in inner)
    assert all(level == 5 for level, _, _, e in cells if e is not None)


def test_ranks_of_ties_and_even_tasks(spark):
    rows = spark.range(3000).select(F.lit(1).alias("day"), (F.col("id") % 7).alias("v"), F.lit(None).cast("string").alias("s"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = ranked(rows, "day", ties=["v"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = out.orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 3001)) and {r["total"] for r in got} == {3000}
    assert [r["v"] for r in got] == sorted(r["v"] for r in got)
    sizes = [r["count"] for r in out.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 1200  # one time and seven values, and still even tasks
    assert ranked(rows.limit(0), "day").collect() == []


def test_split_of_one_moment(spark):
    rows = spark.range(200).select(F.lit("2024-01-01").cast("timestamp_ntz").alias("t"), "id")
    counts = {r["split"]: r["count"] for r in time_split(rows, "t", ties=["id"]).groupBy("split").count().collect()}
    assert counts == {"train": 140, "validation": 30, "test": 30}
