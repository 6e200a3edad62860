"""Interval sweeps against theta joins, and how they are dealt out."""

import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.operators.intervals import Deal, _dealt, _sides, cut_points, overlap_counts, overlap_join


def theta(a, b):
    return sorted((i, j) for i, s, e in a for j, s2, e2 in b if None not in (s, e, s2, e2) and s <= e and s2 <= e2 and s <= e2 and s2 <= e)


def pairs(spark, a, b, kind, **options):
    left, right = spark.createDataFrame(a, f"i int, s {kind}, e {kind}").repartition(3), spark.createDataFrame(b, f"j int, s2 {kind}, e2 {kind}").repartition(2)
    return sorted(map(tuple, overlap_join(left, right, "s", "e", "s2", "e2", **options).select("i", "j").collect()))


@pytest.mark.parametrize("kind", ["bigint", "double", "date", "timestamp_ntz", "timestamp"])
def test_equals_theta(spark, kind):
    rng = random.Random(11)
    make = {"bigint": lambda x: x, "double": lambda x: x / 7, "date": lambda x: date(2024, 1, 1) + timedelta(days=x), "timestamp_ntz": lambda x: datetime(1969, 12, 30) + timedelta(hours=x, microseconds=x), "timestamp": lambda x: datetime(2024, 3, 30) + timedelta(minutes=17 * x)}[kind]

    def some(n):
        out = []
        for i in range(n):
            s = rng.choice([5, rng.randrange(100)])
            out.append((i, make(s), make(s + rng.choice([0, 1, 7, 200, -3]))))
        return out + [(n, None, make(3)), (n + 1, make(3), None)]

    a, b = some(70), some(60)
    assert pairs(spark, a, b, kind, ranges=7) == theta(a, b)


def test_edges_and_empty_sides(spark):
    a, b = [(1, 5, 5), (2, 5, 9)], [(1, 5, 5), (2, 9, 12), (3, 10, 11)]
    assert pairs(spark, a, b, "bigint") == [(1, 1), (2, 1), (2, 2)]
    assert pairs(spark, a, b, "bigint", ranges=1) == [(1, 1), (2, 1), (2, 2)]
    assert pairs(spark, [], b, "bigint") == [] == pairs(spark, a, [], "bigint")
    nan = float("nan")
    assert pairs(spark, [(1, 1.0, nan)], [(1, 1e300, nan), (2, 0.0, 0.5)], "double") == [(1, 1)]


def test_columns_of_any_kind_travel(spark):
    a = spark.createDataFrame([(1, 2, [1, 2], {"x": 1})], "s int, e int, arr array<int>, `a.b` map<string,int>")
    b = spark.createDataFrame([(2, 3, "y")], "`s 2` int, e2 int, part string")
    got = overlap_join(a, b, "s", "e", "s 2", "e2").collect()
    assert [tuple(r) for r in got] == [(1, 2, [1, 2], {"x": 1}, 2, 3, "y")]


@pytest.mark.parametrize("hot", [0.0, 0.6])
def test_no_task_has_more_than_its_share(spark, hot):
    """Nine tenths of one side start in one month, or most at one moment; points and intervals of a range and lane stay few."""
    n = 6000
    start = F.when(F.col("id") < n * hot, 777).when(F.col("id") % 10 < 9, F.col("id") % 30 + 700).otherwise(F.col("id") % 3000)
    a = spark.range(n).select(F.col("id").alias("i"), start.cast("double").alias("s"), (start + 0.5).cast("double").alias("e"))
    b = spark.range(600).select(F.col("id").alias("j"), (F.col("id") * 5 + 0.25).alias("s2"), (F.col("id") * 5 + 3.0).alias("e2"))
    sides = _sides(a, b, "s", "e", "s2", "e2")
    deal = Deal(*cut_points(sides, 16)).measure(sides, 16)
    sizes = [r["count"] for r in _dealt(sides, deal).groupBy("part", "la", "lb").count().collect()]
    assert max(sizes) < 4 * n / 16 and len(sizes) >= 16
    assert overlap_join(a, b, "s", "e", "s2", "e2", ranges=16).count() == a.join(b, (F.col("s") <= F.col("e2")) & (F.col("s2") <= F.col("e"))).count()


def test_ranges_of_hot_bounds():
    deal = Deal(np.array([3, 5, 5, 5, 9]), np.array([5, 5]))
    assert deal.part_of(np.array([1, 3, 4, 5, 6, 9, 10])).tolist() == [1, 3, 3, 4, 5, 7, 7]
    assert deal.exists(np.arange(1, 8)).tolist() == [True, False, True, True, True, False, True]
    assert deal.lanes_of(np.array([3, 4, 5]), 0).tolist() == [1, 1, 1] and deal.parts == 8


def test_lanes_follow_what_is_lent(spark):
    """Forty long intervals lie in every range; each range gets lanes for them."""
    a = spark.range(400).select(F.lit(0).alias("s"), (F.col("id") % 10 * 10 + 900).alias("e"))
    b = spark.range(1000).select(F.col("id").alias("s2"), F.col("id").alias("e2"))
    sides = _sides(a, b, "s", "e", "s2", "e2")
    deal = Deal(*cut_points(sides, 8)).measure(sides, 8)
    assert max(deal.lanes[0]) == 2 and overlap_join(a, b, "s", "e", "s2", "e2", ranges=8).count() == a.join(b, (F.col("s2") <= F.col("e"))).count()


@pytest.mark.parametrize("kind", ["bigint", "double"])
def test_counts_are_those_of_the_pairs(spark, kind):
    """No pair is made: 20,000 intervals a side of one place meet 400 million times, beside others that are met in part, or have no end."""
    rng = random.Random(3)
    some = [(i, s, None if i % 50 == 0 else s + rng.choice([0, 1, 9, 70, -2])) for i in range(300) for s in [rng.randrange(90)]]
    like = lambda df, *names: df.withColumns({c: F.col(c).cast(kind) for c in names})
    a, b = like(spark.createDataFrame(some, "i int, s int, e int").repartition(3), "s", "e"), like(spark.createDataFrame(some[::-2], "j int, s2 int, e2 int").repartition(2), "s2", "e2")
    want = {i: sum(None not in (e, e2) and s <= e and s2 <= e2 and s <= e2 and s2 <= e for _, s2, e2 in some[::-2]) for i, s, e in some}
    for ranges in (1, 7, 64):
        assert {r["i"]: r["n"] for r in overlap_counts(a, b, "s", "e", "s2", "e2", ranges=ranges).collect()} == want
    assert {r["n"] for r in overlap_counts(a, b.limit(0), "s", "e", "s2", "e2").collect()} == {0} and overlap_counts(a.limit(0), b, "s", "e", "s2", "e2").count() == 0
    many = spark.range(20000).select(F.lit(500).cast(kind).alias("s"), F.lit(510).cast(kind).alias("e"))
    left = a.select("s", "e").unionByName(many)
    got = overlap_counts(left, many.withColumnsRenamed({"s": "s2", "e": "e2"}), "s", "e", "s2", "e2").where("n > 0").agg(F.count("*"), F.sum("n")).first()
    assert tuple(got) == (20000, 400_000_000)
