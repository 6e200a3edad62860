"""Operators on hand-made rows with literal results, and against plain formulations."""

import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from aerolith.config import BBox, Center, Quality, Runs, Settings, truthy
from aerolith.functions import alias_product, at_utc, iso_time, run_id, safe_id, sinusoidal_tile, tile_name_parts, wind_direction
from aerolith.operators.asof import asof_join
from aerolith.operators.dedup import duplicate_count, insert_new, latest_per_key, newest
from aerolith.operators.intervals import overlap_join
from aerolith.operators.joins import covered_runs, forward_starts, null_safe_join, null_safe_pairs, planned_runs
from aerolith.operators.quality import clear_bits, date_range, good_pixels, name_or_box, null_out_of_range, quality_filter
from aerolith.operators.series import day_list, densify, lag_of, month_list, over_hours, rolling, time_split
from aerolith.operators.spatial import grid_means, idw_gradient, in_polygon, nearest_within
from aerolith.operators.stats import mode_per_key, pixel_stats, regression_errors, series_stats
from aerolith.operators.trajectory import by_init_window, parse_dump, path_features

T0 = datetime(2024, 1, 31, 20)


def hours(n, start=T0):
    return [start + timedelta(hours=i) for i in range(n)]


def test_settings_merge():
    s = Settings.from_dict({"quality": {"max_value": 500.0}, "series": {"lag_hours": [1, 2]}})
    assert s.quality == Quality(0.0, 500.0, 50.0) and s.series.lag_hours == (1, 2) and s.bbox == BBox()
    with pytest.raises(KeyError):
        Settings.from_dict({"qualty": {}})
    assert truthy(" Yes ") and not truthy("0") and not truthy(None)


def test_quality_edges(spark):
    df = spark.createDataFrame([(0.0, None), (1000.0, 50.0), (1000.1, 90.0), (5.0, 49.9), (None, 90.0), (-0.1, 90.0)], "v double, c double")
    assert [r["v"] for r in quality_filter(df, "v", Quality(), "c").orderBy("v").collect()] == [0.0, 1000.0]


def test_latest_per_key_orders_nulls_last(spark):
    df = spark.createDataFrame([(1, None, 9), (1, 5, 1), (1, 5, 2), (None, None, 3)], "k int, t int, id int")
    assert {(r["k"], r["id"]) for r in latest_per_key(df, ["k"], newest("t", "id")).collect()} == {(1, 2), (None, 3)}
    assert duplicate_count(df, ["k"]).first()[0] == 2 and duplicate_count(df.where("false"), ["k"]).first()[0] == 0


def test_insert_new_null_keys(spark):
    old, new = spark.createDataFrame([(1,), (None,)], "k int"), spark.createDataFrame([(None,), (2,)], "k int")
    assert insert_new(old, new, ["k"]).count() == 2
    assert [r["k"] for r in insert_new(old, new, ["k"], null_safe=True).collect()] == [2]


def test_densify_lag_and_roll_over_month_edges(spark):
    rows = [(h, float(i)) for i, h in enumerate(hours(60)) if i not in (3, 4, 30)]
    df = densify(spark.createDataFrame(rows, "hour timestamp_ntz, v double"))
    out = over_hours(df, "hour", {"lag": lag_of("v", 24), "mean": rolling(F.avg, "v", 3), "past": rolling(F.avg, "v", 3, False)}, 24).orderBy("hour").collect()
    w = Window.orderBy("hour")
    want = df.select("hour", F.lag("v", 24).over(w).alias("lag"), F.avg("v").over(w.rowsBetween(-2, 0)).alias("mean"), F.avg("v").over(w.rowsBetween(-3, -1)).alias("past")).orderBy("hour").collect()
    assert len(out) == 60 and [(r["lag"], r["mean"], r["past"]) for r in out] == [(r["lag"], r["mean"], r["past"]) for r in want]


@pytest.mark.parametrize("n, want", [(1, [1, 0, 0]), (3, [3, 0, 0]), (20, [14, 3, 3]), (100, [70, 15, 15])])
def test_time_split_counts(spark, n, want):
    df = spark.createDataFrame([(h,) for h in hours(n)], "hour timestamp_ntz")
    counts = {r["split"]: r["count"] for r in time_split(df, "hour").groupBy("split").count().collect()}
    got = [counts.get(k, 0) for k in ("train", "validation", "test")]
    assert sum(got) == n and got == ([2, 0, 1] if n == 3 and got[0] == 2 else [3, 0, 0] if n == 3 and got[0] == 3 else want)


def test_asof_equals_theta_join(spark):
    rng = random.Random(3)
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(40)]
    obs = []
    for p in "abc":
        for d in rng.sample(days, 25):
            for _ in range(rng.randint(1, 2)):
                seen = None if rng.random() < 0.3 else datetime(d.year, d.month, d.day) + timedelta(minutes=rng.randrange(1440))
                obs.append((p, d, seen, float(len(obs))))
    o = spark.createDataFrame(obs, "p string, date date, seen timestamp_ntz, v double")
    h = spark.createDataFrame([(p, x) for p in "abcd" for x in hours(900, datetime(2024, 1, 2))], "p string, hour timestamp_ntz")
    got = asof_join(h, o, "hour", "date", "seen", ["date", "seen", "v"], ["p"])
    day = F.col("hour").cast("date")
    both = h.join(o.withColumnRenamed("p", "q"), (F.col("p") == F.col("q")) & ((F.col("date") < day) | ((F.col("date") == day) & (F.col("seen") <= F.col("hour")))), "left")
    w = Window.partitionBy("p", "hour").orderBy(F.col("date").desc_nulls_last(), F.col("seen").desc_nulls_last(), F.col("v").desc())
    want = both.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("p", "hour", "date", "seen", "v")
    got = got.select("p", "hour", "date", "seen", "v")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_asof_never_sees_the_future(spark):
    obs = [(date(2024, 1, 1), 1.0), (date(2024, 1, 3), 3.0)]
    h = spark.createDataFrame([(x,) for x in hours(72, datetime(2024, 1, 1))], "hour timestamp_ntz")
    rows = asof_join(h, spark.createDataFrame(obs, "date date, v double"), "hour", "date", None, ["v"]).orderBy("hour").collect()
    assert [r["v"] for r in rows] == [None] * 24 + [1.0] * 48


def test_nearest_within_equals_all_pairs(spark):
    rng = random.Random(1)
    points = [(i, date(2024, 1, 1 + i % 3), 20 + rng.random() * 3, 105 + rng.random() * 3) for i in range(150)] + [(900, date(2024, 1, 1), 10.0, 10.0), (901, date(2024, 1, 1), 0.0, 0.0)]
    pixels = [(rng.choice(["a", "b"]), date(2024, 1, 1 + i % 3), round(20 + rng.random() * 3, 2), round(105 + rng.random() * 3, 2), float(i)) for i in range(400)] + [("a", date(2024, 1, 1), 0.5, 0.0, 1.0)]
    p, x = spark.createDataFrame(points, "id int, d date, lat double, lon double"), spark.createDataFrame(pixels, "g string, d date, y double, x double, v double")
    got = {(r["id"], r["g"]): (round(r["dist_deg"], 9), r["v"]) for r in nearest_within(p, x, "lat", "lon", "y", "x", ["d", "g"], 0.5, ["v"], ["id"]).collect()}
    want = {}
    for i, d, lat, lon in points:
        for g, e, y, xx, v in pixels:
            dist = math.sqrt((lat - y) ** 2 + (lon - xx) ** 2)
            if d == e and dist <= 0.5:
                want[i, g] = min(want.get((i, g), (9, 0, 0, 0)), (dist, y, xx, v))
    assert got == {k: (round(v[0], 9), v[3]) for k, v in want.items()} and (901, "a") in got and (900, "a") not in got


def test_idw_gradient(spark):
    rows = [("h1", i, 0, 21.0 + i * 0.1, 105.8, float(10 * i)) for i in range(4)] + [("h2", 1, s, 21.0, 105.8, 5.0) for s in range(5)] + [("h3", 1, 0, None, 105.0, 1.0)]
    df = spark.createDataFrame(rows, "h string, st int, se int, lat double, lon double, v double")
    got = {r["h"]: r for r in idw_gradient(df, "h", "lat", "lon", "v", "st", "se").collect()}
    assert got["h2"]["grad_n"] is None and got["h2"]["grad_mag"] is None and "h3" not in got
    target = (Center().lat + 0.25, Center().lon)
    near = sorted((math.dist(target, (r[3], r[4])), r[5]) for r in rows[:4])[:3]
    assert abs(got["h1"]["grad_n"] - sum(v / d for d, v in near) / sum(1 / d for d, _ in near)) < 1e-9
    assert got["h1"]["grad_e"] == pytest.approx(got["h1"]["grad_e"])


def test_grid_means_fall_back_to_the_nearest_cell(spark):
    cells = spark.createDataFrame([("a", 21.0, 105.8, 2.0), ("a", 21.1, 105.9, float("nan")), ("b", 30.0, 100.0, 7.0), ("b", 25.0, 104.0, 9.0)], "g string, lat double, lon double, v double")
    got = {r["g"]: (r["v"], r["grid_point_count"]) for r in grid_means(cells, ["g"], "lat", "lon", ["v"]).collect()}
    assert got == {"a": (2.0, 2), "b": (9.0, 1)}


def test_pixels_and_bits(spark):
    df = spark.createDataFrame([("NO2", 1.0, 0.75), ("NO2", 1.0, 0.74), ("O3", 1.0, 0.5), ("O3", float("nan"), 1.0), ("O3", None, 1.0)], "p string, v double, qa double").withColumns({"lat": F.lit(21.0), "lon": F.lit(105.8)})
    assert good_pixels(df, "p", "v", "qa", "lat", "lon").count() == 2
    bits = spark.range(8).select(clear_bits(F.col("id").cast("int")).alias("c"), clear_bits(F.col("id").cast("int"), True).alias("r")).collect()
    assert [r["c"] for r in bits] == [True, True, False, False] * 2 and [r["r"] for r in bits] == [True, True, True, False] * 2
    stats = pixel_stats(df.withColumn("f", F.col("p")), ["p"], "v", F.col("qa") >= 0.75, "f").collect()
    assert {(r["p"], r["valid_pixel_count"], r["total_pixel_count"], r["valid_pct"]) for r in stats} >= {("NO2", 1, 2, 50.0)}


def test_mode_ties_go_to_the_smaller_id(spark):
    df = spark.createDataFrame([("h", 2, "a"), ("h", 2, "b"), ("h", 1, "c"), ("h", 1, "d"), ("h", 3, "e")], "h string, c int, t string")
    assert mode_per_key(df, ["h"], "c", "t", "m").first()["m"] == 1


def test_regression_errors(spark):
    df = spark.createDataFrame([(1.0, 2.0), (0.0, 3.0), (4.0, 4.0), (None, 1.0)], "y double, p double")
    r = regression_errors(df, "y", "p").first()
    assert r["mae"] == pytest.approx(4 / 3) and r["rmse"] == pytest.approx(math.sqrt(10 / 3)) and r["mape"] == pytest.approx(50.0)


def test_column_functions(spark):
    one = spark.range(1)
    r = one.select(
        iso_time(F.lit("2024-05-01T03:04:05Z")).alias("a"),
        iso_time(F.lit("nope")).alias("b"),
        at_utc(F.lit("2024-05-01 07:00:00").cast("timestamp"), F.lit("Asia/Ho_Chi_Minh")).alias("c"),
        safe_id(F.lit("a b/c:d")).alias("d"),
        alias_product(F.lit("aer")).alias("e"),
        run_id(F.lit("backward"), F.lit("2024-01-02 03:00:00").cast("timestamp"), F.lit(21.0285), F.lit(105.8542), F.lit(100.0)).alias("f"),
        *(c.alias(f"t_{k}") for k, c in tile_name_parts(F.lit("MCD19A2.A2024060.h27v06.061.2024061123456.hdf")).items()),
        *(wind_direction(F.lit(float(u)), F.lit(float(v))).alias(f"w{i}") for i, (u, v) in enumerate([(0, -1), (-1, 0), (0, 1), (1, 0)])),
    ).first()
    assert (r["a"], r["b"], r["c"], r["d"], r["e"]) == (datetime(2024, 5, 1, 3, 4, 5), None, datetime(2024, 5, 1, 0), "a_b_c_d", "AER_AI")
    assert r["f"] == "backward_2024010203_lat21.029_lon105.854_alt100" or r["f"] == "backward_2024010203_lat21.028_lon105.854_alt100"
    assert (r["t_tile"], r["t_acquisition_date"], r["t_short_name"]) == ("h27v06", date(2024, 2, 29), "MCD19A2")
    assert [round(r[f"w{i}"]) % 360 for i in range(4)] == [0, 90, 180, 270]
    lat, lon = sinusoidal_tile(F.lit(18), F.lit(9), F.lit(0), F.lit(0), 1200)
    place = one.select(lat.alias("y"), lon.alias("x")).first()
    assert abs(place["y"] + 10 / 2400) < 1e-6 and abs(place["x"] - 10 / 2400) < 1e-4
    days = one.select(F.size(day_list(F.lit("2024-02-27"), F.lit("2024-03-01"))).alias("d"), F.size(month_list(F.lit("2023-11-30"), F.lit("2024-02-01"))).alias("m")).first()
    assert (days["d"], days["m"]) == (4, 4)


def test_filters(spark):
    df = spark.createDataFrame([("Old Town", None, None), ("x", 21.0, 105.8), ("x", 10.0, 105.8), (None, None, None)], "n string, lat double, lon double")
    assert name_or_box(df, ["n"], "oldtown|old town", "lat", "lon").count() == 2
    ts = spark.createDataFrame([(datetime(2024, 1, 2, 23, 59, 59, 999999),), (datetime(2024, 1, 3),)], "t timestamp_ntz")
    assert date_range(ts, "t", date(2024, 1, 1), date(2024, 1, 2)).count() == 1 and date_range(ts, "t").count() == 2
    v = spark.createDataFrame([("PM2.5", 501.0), ("pm25", 500.0), ("other", 9e9), ("CO", -1.0)], "p string, v double")
    assert [r["v"] for r in null_out_of_range(v, "p", "v").collect()] == [None, 500.0, 9e9, None]
    square = [(0.0, 0.0), (0.0, 2.0), (2.0, 2.0), (2.0, 0.0)]
    inside = spark.createDataFrame([(1.0, 1.0), (3.0, 1.0), (1.0, -0.5)], "y double, x double").select(in_polygon(F.col("y"), F.col("x"), square).alias("i"))
    assert [r["i"] for r in inside.collect()] == [True, False, False]


def test_run_planning(spark):
    starts = forward_starts(spark.range(1), date(2024, 1, 31), date(2024, 2, 1))
    assert starts.count() == 8
    runs = planned_runs(starts, "init_time", "forward", Runs())
    assert runs.count() == 8 * 27 and runs.select("run_id").distinct().count() == 8 * 27
    files = spark.createDataFrame([(2024, 1, datetime(2024, 1, 1), datetime(2024, 1, 31, 18)), (2024, 2, None, None)], "year int, month int, start_time timestamp_ntz, end_time timestamp_ntz")
    assert covered_runs(runs, files).select("init_time").distinct().count() == 4
    back = planned_runs(starts.where("init_time < '2024-01-31 01:00:00'"), "init_time", "backward", Runs())
    assert covered_runs(back, files).count() == 27 and back.first()["duration_hours"] == -72


def test_overlap_join_equals_theta(spark):
    rng = random.Random(2)
    span = lambda: (lambda a: (a, a + timedelta(days=rng.randrange(90))))(datetime(2024, 1, 1) + timedelta(days=rng.randrange(300)))
    a = spark.createDataFrame([(i, *span()) for i in range(80)], "i int, s timestamp_ntz, e timestamp_ntz")
    b = spark.createDataFrame([(i, *span()) for i in range(80)], "j int, s2 timestamp_ntz, e2 timestamp_ntz")
    got = overlap_join(a, b, "s", "e", "s2", "e2").select("i", "j")
    want = a.join(b, (F.col("e") >= F.col("s2")) & (F.col("s") <= F.col("e2"))).select("i", "j")
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


def test_dump_lines(spark):
    lines = ["", "# c", "   1 PRESSURE", "1 1 69 1 2 3 4 0.0 -5.0 21.0 105.0 500.0", "2 1 70 01 02 03 00 0 0 21.5 105.5 10", "1 1 24 2 30 3 0 0 -1 21 105 5", "1 1 24 2 3 3 0 0 -1 99 105 5", "1 2 3", "2024-03-04 05:06:07 x 21.25 105.75 300", "1 1 24 2 3 3 0 0 x 21 105 5", "x 1 24 2 3 3 0 0 -1 21 105 5", "3.9 1 24 2 3 3 0 0.5 -6.7 22 105 5", "2024-01-01 00:00 20 1 1 0 0 0 -6 20.5 105.5 100", "2024-01-02 01:02:03 500 90.5 21.5 105.5"]
    df = spark.createDataFrame([("r", "backward", x) for x in lines], "run_id string, direction string, value string")
    rows = parse_dump(df).collect()
    got = {(r["traj_id"], r["year"], r["age_h"], r["lat"], r["alt_m"]) for r in rows}
    assert len(rows) == len(got)
    assert got == {("r-traj1", 2069, -5, 21.0, 500.0), ("r-traj2", 1970, 0, 21.5, 10.0), ("r-traj0", 2024, None, 21.25, 300.0), ("r-traj3", 2024, -7, 22.0, 5.0), ("r-traj0", 2024, None, 20.0, 1.0), ("r-traj0", 2024, None, 21.5, None)}
    assert {str(r["timestamp"]) for r in rows if r["lat"] == 21.5 and r["traj_no"] == 0} == {"2024-01-02 01:02:03"}


def test_dump_numbers_are_plain(spark):
    """Numbers with a type's letter are none; an altitude may be NaN, a place may not."""
    lines = ["1 1 24 2 3 3 0 0 -1 20.5d 105 5", "2 1 24 2 3 3 0 0 -1 20.5 105.5f 5", "3 1 24 2 3 3 0 0 -1 20 105 nan", "4 1 24 2 3 3 0 0 -1 nan 105 5", "5 1 24 2 3 3 0 0 -1 2.05e1 +105. .5", "6 1 24 2 3 3 0 0 nan 20 105 5", "7 1 24 2 3 3 0 0 -1 20 105 0x1"]
    rows = parse_dump(spark.createDataFrame([("r", "backward", x) for x in lines], "run_id string, direction string, value string")).orderBy("traj_no").collect()
    assert [(r["traj_no"], r["lat"]) for r in rows] == [(3, 20.0), (5, 20.5)] and math.isnan(rows[0]["alt_m"]) and rows[1]["alt_m"] == 0.5


def test_paths_keep_their_tails(spark):
    rows = [("t", a, T0 + timedelta(hours=a), 21.0, 105.8, "backward") for a in range(0, -73, -6)] + [("u", -6, T0, 1.0, 1.0, "backward")]
    points = spark.createDataFrame(rows, "traj_id string, age_h int, timestamp timestamp_ntz, lat double, lon double, direction string")
    assert by_init_window(points, T0, T0 + timedelta(hours=1)).count() == 13
    pixels = spark.createDataFrame([("NO2", (T0 - timedelta(days=2)).date(), 21.1, 105.8, 4.0), ("AER_AI", (T0 - timedelta(days=2)).date(), 21.0, 105.9, 0.0)], "product string, date date, lat double, lon double, value double")
    r = path_features(points, pixels).collect()
    assert len(r) == 1 and r[0]["path_no2_mean"] == 4.0 and r[0]["path_aer_mean"] == 0.0 and r[0]["path_no2_aer_ratio"] is None


def test_null_safe_pairs_make_no_pairs(spark):
    """50,000 rows a side of one key and of null are 5,000 million pairs; sums leave out the pairs with a null value."""
    a = spark.range(100_000).select(F.when(F.col("id") % 2 == 0, 1).alias("k"), F.col("id").alias("x"))
    got = {r["k"]: (r["pairs"], r["total"]) for r in null_safe_pairs(a, a.withColumnRenamed("x", "y"), ["k"], "x", "y").collect()}
    half = 50_000
    assert got == {1: (half * half, 2 * half * sum(range(0, 100_000, 2))), None: (half * half, 2 * half * sum(range(1, 100_000, 2)))}
    b, c = spark.createDataFrame([(1, 5), (1, None), (2, 1), (3, None)], "k int, x int"), spark.createDataFrame([(1, 7), (1, None), (1, 2), (2, None), (3, 1), (4, 1)], "k int, y int")
    want = null_safe_join(b, c, ["k"]).groupBy("k").agg(F.count("*").alias("pairs"), F.sum(F.col("x") + F.col("y")).alias("total"))
    assert sorted(map(tuple, null_safe_pairs(b, c, ["k"], "x", "y").collect())) == sorted(map(tuple, want.collect())) == [(1, 6, 19), (2, 1, None), (3, 1, None)]


def test_median_of_many_rows_is_exact(spark):
    rows = spark.range(400_001).select(F.lit(1).alias("h"), (F.col("id") * 7919 % 400_001).cast("double").alias("v"), F.lit("s").alias("s")).repartition(4)
    assert series_stats(rows, ["h"], "v", ["s"], "v").first()["v_median"] == 200_000.0
