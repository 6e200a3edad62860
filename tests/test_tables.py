"""Registry, sinks, readers, streams, checks, models."""

import json
from datetime import UTC, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.checks import checks
from aerolith.checks.checks import compact, freshness, maintain, null_ratio_check, reconcile, schema_hash
from aerolith.ml.cluster import clusters, cost_by_k
from aerolith.ml.forecast import fit_horizon, importance, newest_model, predicted, run_record, train_horizons
from aerolith.plans.gold import MASTER_COLUMNS, TRAINING_COLUMNS, master, training
from aerolith.plans.registry import TABLES, Table, ensure
from aerolith.plans.silver import aerosol_daily, city_hourly, gradient_hourly, station_hourly, surface_hourly, swath_daily, weather_hourly
from aerolith.sinks.serving import kafka_rows, key_collisions, last_write_wins, paths_as_lines, sensor_rows, weather_rows
from aerolith.sinks.upsert import append_new, delete_where, empty_table, full_refresh, merged, read_or_none, replace_partitions, upsert
from aerolith.sources.raster import aod_values, cube_values, read_pixels, swath_values
from aerolith.sources.readers import csv_table, dump_lines, file_digests, file_inventory, first_available, resolved_files, tolerant, weather_files
from aerolith.streaming.pipelines import append_to, deduplicated, file_source, flattened, lag_of, parsed, progress, sessions, upsert_to, windowed
from aerolith.streaming.windows import days_of, ingest_window, months_of

T0 = datetime(2024, 3, 1)


def test_registry_has_every_table(spark):
    assert len(TABLES) == 22 and len(MASTER_COLUMNS) == 74 and len(TRAINING_COLUMNS) == 79
    for t in TABLES.values():
        names = t.schema().fieldNames()
        assert len(set(names)) == len(names) and set(t.keys) | set(t.partition_by) <= set(names)


def test_ensure_adds_columns(spark, tmp_path):
    name = "evolving"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert ensure(spark, Table(name, "a INT, p INT", (), ("p",)), location=f"{tmp_path}/t") == []
    spark.sql(f"INSERT INTO {name} VALUES (1, 2)")
    assert ensure(spark, Table(name, "a INT, b ARRAY<STRING>, p INT", (), ("p",))) == ["b"]
    assert spark.table(name).where("b IS NULL").count() == 1
    spark.sql(f"DROP TABLE {name}")


def test_upsert_is_idempotent_and_touches_its_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, "b", 1)], "k int, p string, v int")
    upsert(rows, path, ["k"], ["p"])
    before = {f for f in spark.read.parquet(path).where("p = 'b'").inputFiles() if "p=b" in f}
    new = spark.createDataFrame([(2, "a", 9), (4, "a", 9)], "k int, p string, v int")
    for _ in range(2):
        upsert(new, path, ["k"], ["p"])
        assert sorted(map(tuple, spark.read.parquet(path).select("k", "p", "v").collect())) == [(1, "a", 1), (2, "a", 9), (3, "b", 1), (4, "a", 9)]
    assert {f for f in spark.read.parquet(path).inputFiles() if "p=b" in f} == before
    with pytest.raises(ValueError):
        upsert(new.unionByName(new), path, ["k"], ["p"])
    delete_where(spark, path, F.col("v") == 9, ["p"])
    assert sorted(r["k"] for r in spark.read.parquet(path).collect()) == [1, 3]
    append_new(spark.createDataFrame([(1, "a", 5), (7, "c", 5)], "k int, p string, v int").select("k", "v", "p"), f"{tmp_path}/u", ["k"])
    append_new(spark.createDataFrame([(1, 5, "a"), (8, 5, "c")], "k int, v int, p string"), f"{tmp_path}/u", ["k"])
    assert sorted(r["k"] for r in spark.read.parquet(f"{tmp_path}/u").collect()) == [1, 7, 8]


def test_merge_null_keys_and_refresh(spark, tmp_path):
    old, new = spark.createDataFrame([(None, 1), (1, 1)], "k int, v int"), spark.createDataFrame([(None, 2)], "k int, v int")
    assert merged(old, new, ["k"]).count() == 3 and merged(old, new, ["k"], null_safe=True).count() == 2
    path = f"{tmp_path}/r"
    replace_partitions(spark.createDataFrame([(i, 0) for i in range(6)], "k int, v int"), path)
    full_refresh(spark.createDataFrame([(2, 9), (4, 9)], "k int, v int"), path, "k")
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(0, 0), (1, 0), (2, 9), (4, 9), (5, 0)]
    path = f"{tmp_path}/days"
    days = spark.createDataFrame([(h, h // 10, 0) for h in range(50)], "h int, day int, v int")
    full_refresh(days, path, "h", ["day"])
    full_refresh(spark.createDataFrame([(12, 1, 9), (33, 3, 9)], "h int, day int, v int"), path, "h", ["day"])
    assert sorted((r["h"], r["v"]) for r in spark.read.parquet(path).collect()) == [*((h, 0) for h in range(12)), (12, 9), (33, 9), *((h, 0) for h in range(34, 50))]
    full_refresh(days.where("false"), path, "h", ["day"])
    assert spark.read.parquet(path).count() == 30
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"no parquet at all")
    with pytest.raises(Exception, match="(?i)parquet"):  # what cannot be read must not be overwritten
        upsert(days, f"{tmp_path}/broken", ["h"])
    assert read_or_none(spark, f"{tmp_path}/none") is None and empty_table(spark, "a int").count() == 0
    spark.range(100).repartition(20).write.parquet(f"{tmp_path}/small")
    report = compact(spark, f"{tmp_path}/small")
    assert report["files_before"] == 20 and report["files_after"] == 1 and spark.read.parquet(f"{tmp_path}/small").count() == 100
    assert [r["ok"] for r in maintain(spark, "none", ["t"])] == [False] * 3


def test_serving(spark):
    rows = spark.createDataFrame([("a", "d", 1, 5, "x"), ("a", "d", 1, 7, "y"), ("a", "d", None, 9, "z")], "city string, day string, t int, ingest_time int, event_id string")
    assert [r["event_id"] for r in last_write_wins(rows, ["city", "day", "t"]).collect()] == ["y"]
    assert key_collisions(rows, ["city", "day", "t"], ["event_id"]).first()["sources"] == 2
    lines = paths_as_lines(spark.createDataFrame([("t", 2, 1.0, 3.0), ("t", 1, 0.0, 2.0)], "id string, o int, y double, x double"), "id", "o", "y", "x").first()
    assert json.loads(lines["value"])["geometry"]["coordinates"] == [[2.0, 0.0], [3.0, 1.0]]
    assert json.loads(kafka_rows(rows).first()["value"])["event_id"] == kafka_rows(rows).first()["key"]
    blank = TABLES["sensor_bronze"].schema()
    s = spark.createDataFrame([], blank).withColumn("day", F.lit(None).cast("string"))
    assert sensor_rows(s).count() == 0
    w = spark.createDataFrame([], TABLES["weather_bronze"].schema())
    assert weather_rows(w).count() == 0


def test_checks(spark):
    df = spark.createDataFrame([(1, T0), (2, T0), (None, T0)], "k int, t timestamp")
    r = reconcile(df, df.where("k = 1"), "k", "t", F.lit(T0 - timedelta(days=1)), 0.5).first()
    assert (r["source_keys"], r["serving_keys"], r["ratio"], r["ok"]) == (2, 1, 0.5, True)
    assert reconcile(df.where("false"), df, "k", "t", F.lit(T0)).first()["ratio"] == 1.0
    assert freshness(df, "t", F.lit(T0 + timedelta(hours=3)), 2.0).first()["ok"] is False and freshness(df.where("false"), "t", F.lit(T0), 2.0).first()["ok"] is False
    assert [r["ok"] for r in null_ratio_check(df, {"k": 0.3, "t": 0.0}).orderBy("column").collect()] == [False, True]
    a, b = (spark.range(1).select(schema_hash(c)).first()[0] for c in ([("x", "int")], [("x", "double")]))
    assert a != b and len(a) == 64


def test_readers(spark, tmp_path):
    day = {"location": {"name": "X", "region": "R", "country": "C", "lat": 21.0, "lon": 105.8, "tz_id": "Asia/Ho_Chi_Minh"}, "forecast": {"forecastday": [{"date": "2025-01-05", "hour": [{"time": f"2025-01-05 {h:02d}:00", "time_epoch": h, "temp_c": float(h), "condition": {"text": "Sunny", "code": 1000}} for h in range(24)]}]}}
    (tmp_path / "w" / "Some_Place").mkdir(parents=True)
    (tmp_path / "w" / "Some_Place" / "2025-01-05.json").write_text(json.dumps(day, indent=1))
    rows = weather_files(spark, f"{tmp_path}/w").orderBy("time_epoch").collect()
    assert len(rows) == 24 and rows[3]["province"] == "Some_Place" and rows[3]["query_date"] == "2025-01-05" and rows[3]["condition_code"] == 1000 and rows[3]["event_id"] == "weather_Some_Place_3"
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "tdump.1").write_text("a\nb\n")
    runs = spark.createDataFrame([("r1", "backward", "hdfs://x/tdump.1"), ("r2", "backward", "hdfs://x/tdump.2")], "run_id string, direction string, output_path string")
    assert sorted(r["value"] for r in dump_lines(spark, runs, f"{tmp_path}/d").where("run_id = 'r1'").collect()) == ["a", "b"]
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "MCD19A2.A2024060.h27v06.061.2024061123456.hdf").write_bytes(bytes.fromhex("0E031301") + b"x" * 20)
    (tmp_path / "f" / "S5P_NO2_a.nc").write_bytes(bytes.fromhex("894844460D0A1A0A"))
    files = {r["format"]: r for r in file_inventory(spark, f"{tmp_path}/f").collect()}
    assert files["hdf4"]["tile"] == "h27v06" and files["hdf5"]["tile"] is None
    assert all(len(r["sha256"]) == 64 for r in file_digests(spark, f"{tmp_path}/f").collect())
    meta = spark.createDataFrame([(1, "nope", "s5p-no2_A"), (2, None, None)], "id int, a string, b string")
    got = {r["id"]: r["source_path"] for r in resolved_files(meta, file_inventory(spark, f"{tmp_path}/f"), ["a", "b"], ["id"]).collect()}
    assert got[1].endswith("S5P_NO2_a.nc") and got[2] is None
    (tmp_path / "c.csv").write_text("id,x\na,1\nb,no\n")
    assert [r["x"] for r in csv_table(spark, f"{tmp_path}/c.csv", "id string, x int").collect()] == [1, None]
    t = tolerant(spark.createDataFrame([("7",)], "a string"), {"a": "int", "b": "double"})
    assert t.dtypes == [("a", "int"), ("b", "double")] and t.first()["a"] == 7
    assert first_available(t, ["zz", "a"], "m").first()["m"] == 7


def test_rasters(spark, tmp_path):
    assert np.isnan(swath_values(np.array([[[1.0, -2e30, 9.0]]]), 9.0)).tolist() == [[False, True, True]]
    assert np.allclose(aod_values(np.array([[[100, -28672]], [[300, -28672]]])), [[0.2, np.nan]], equal_nan=True)
    cube = cube_values(np.arange(8.0).reshape(2, 2, 2), ["lat", "expver", "lon"])
    assert cube.shape == (1, 2, 2) and cube[0, 0, 0] == 1.0
    (tmp_path / "one.bin").write_bytes(np.arange(6, dtype="<f8").tobytes())

    def decode(raw):
        grid = np.frombuffer(raw, "<f8").reshape(2, 3)
        return {"bands": {"b": grid}, "lat": [1.0, 2.0], "lon": [5.0, 6.0, 7.0], "qa": np.ones((2, 3))}

    rows = read_pixels(spark, str(tmp_path), decode).orderBy("value").collect()
    assert [(r["lat"], r["lon"], r["value"]) for r in rows[:4]] == [(1.0, 5.0, 0.0), (1.0, 6.0, 1.0), (1.0, 7.0, 2.0), (2.0, 5.0, 3.0)] and rows[0]["qa"] == 1.0


EVENT = "event_id STRING, time STRING, value DOUBLE, stats STRUCT<min: DOUBLE, max: DOUBLE>"


def write_lines(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))


def test_stream_appends_once_and_goes_on(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "1.json", [{"event_id": "a", "time": "2024-03-01T01:02:03Z", "value": 1.0, "stats": {"min": 0.0, "max": 2.0}}, "not json"])
    stream = lambda: flattened(parsed(file_source(spark, str(source)), EVENT, ["time"]), "stats", ["min", "max"])
    for name, n in (("2.json", 2), ("3.json", 3)):
        q = append_to(stream(), f"{tmp_path}/out", f"{tmp_path}/cp", ["year", "month"])
        q.awaitTermination()
        assert spark.read.parquet(f"{tmp_path}/out").count() == n and progress(q) is not None
        write_lines(source, name, [{"event_id": "b" + name, "time": "2024-03-02T00:00:00Z", "value": 2.0, "stats": None}])
    rows = {r["event_id"]: r for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert rows["a"]["event_time"] == datetime(2024, 3, 1, 1, 2, 3) and rows["a"]["stats_max"] == 2.0 and rows[None]["event_time"] is None
    batch = parsed(spark.read.text(str(source)), EVENT, ["time"], drop_malformed=True)
    assert batch.where("event_id IS NULL").count() == 0


def test_stream_upsert_keeps_the_latest(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "1.json", [{"event_id": "a", "time": "2024-03-01T00:00:00Z", "value": 1.0}, {"event_id": "a", "time": "2024-03-01T01:00:00Z", "value": 2.0}, {"event_id": None, "value": 3.0}])
    for value in (2.0, 5.0):
        rows = parsed(file_source(spark, str(source)), "event_id STRING, time STRING, value DOUBLE", ["time"])
        upsert_to(rows, f"{tmp_path}/out", f"{tmp_path}/cp", ["event_id"], ["event_time"]).awaitTermination()
        assert [(r["event_id"], r["value"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [("a", value)]
        write_lines(source, "2.json", [{"event_id": "a", "time": "2024-03-01T00:30:00Z", "value": 5.0}])


@pytest.mark.parametrize("kind", ["tumbling", "sliding", "session", "dedup"])
def test_windows_equal_batch(spark, sf_dir, tmp_path, kind):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("t"), "value")
    events.unionByName(events.where("event_id % 10 = 0")).repartition(1).sortWithinPartitions("t").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in")
    agg = [F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("v")]
    make = {
        "tumbling": lambda d: windowed(d, "t", "10 minutes", "1 hour", agg, ["event_type"]),
        "sliding": lambda d: windowed(d, "t", "10 minutes", "2 hours", agg, [], "1 hour"),
        "session": lambda d: sessions(d, "t", "10 minutes", "20 minutes", agg, ["event_type"]),
        "dedup": lambda d: deduplicated(d, ["event_id"], "t", "1 hour").select("event_id", "value"),
    }[kind]
    name = f"out_{kind}"
    mode = "append" if kind == "dedup" else "complete" if kind in ("tumbling", "sliding") else "append"
    q = make(stream).writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.table(name)
    if kind == "dedup":
        assert got.count() == events.count()
        return
    want = make(spark.read.parquet(f"{tmp_path}/in"))
    if kind == "session":  # sessions within the lateness of the end stay open
        assert want.exceptAll(got).count() < 20 and got.exceptAll(want).count() == 0 and got.count() > 100
    else:
        assert want.exceptAll(got).count() == 0 == got.exceptAll(want).count()


def test_ingest_windows(spark, tmp_path):
    now = datetime(2024, 3, 1, 12, tzinfo=UTC)
    w = ingest_window("batch", now, lookback_days=0)
    assert w.start == now - timedelta(days=1) and len(days_of(w)) == 2
    w.save(spark, f"{tmp_path}/state")
    assert json.loads(spark.read.text(f"{tmp_path}/state").first()[0]) == w.state()
    assert ingest_window("realtime", now, lookback_minutes=0).start == now - timedelta(minutes=1)
    assert months_of(datetime(2023, 12, 5).date(), datetime(2024, 2, 1).date()) == [(2023, 12), (2024, 1), (2024, 2)]
    with pytest.raises(ValueError):
        ingest_window("batch", now, start=now, end=now)
    with pytest.raises(ValueError):
        ingest_window("often", now)
    assert lag_of({"0": 100, "1": 60_000}, {}) == (0, True) and lag_of({"0": 100, "1": 60_000}, {"0": 90, "1": 1}) == (60_009, False)


def test_silver_to_training(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = []
    for h in range(24 * 12):
        for s in range(4):
            t = T0 + timedelta(hours=h, minutes=int(rng.integers(60)))
            rows.append((f"{h}-{s}", s, "n", "c", 20.9 + 0.1 * s, 105.5 + 0.1 * s, "p", s * 10, "PM2.5", "u", float(rng.integers(5, 90)), 80.0, t, "src", t))
    bronze = spark.createDataFrame(rows, "event_id string, location_id long, location_name string, city string, latitude double, longitude double, provider string, sensor_id long, parameter string, unit string, value double, coverage_pct double, event_time timestamp_ntz, source string, ingest_time timestamp_ntz")
    bronze = bronze.unionByName(bronze.where("event_id = '0-0'").withColumns({"value": F.lit(1000.0), "ingest_time": F.col("ingest_time") + F.expr("interval 1 hour")}))
    stations = station_hourly(bronze)
    stations = stations.withColumn("hour", F.col("hour").cast("timestamp_ntz"))
    assert stations.count() == 24 * 12 * 4 and stations.where("event_id = '0-0'").first()["pm25"] == 1000.0
    air, gradient = city_hourly(stations), gradient_hourly(stations)
    swath = spark.createDataFrame([("AER", (T0 + timedelta(days=d)).date(), T0 + timedelta(days=d, hours=6), float(d), 50.0) for d in range(12)], "product string, date date, overpass_time_utc timestamp_ntz, value_mean double, valid_pct double")
    gold = master(air, gradient=gradient, swath=swath)
    assert gold.columns == [c for c, _ in MASTER_COLUMNS] and gold.count() == 24 * 12
    r = gold.where(F.col("hour") == T0 + timedelta(days=3, hours=5)).first()
    assert r["s5p_aer_ai_mean"] == 2.0 and r["s5p_no2_mean"] is None and r["pm25_grad_n"] is not None
    assert gold.where(F.col("hour") == T0 + timedelta(days=3, hours=6)).first()["s5p_aer_ai_mean"] == 3.0
    train = training(gold, "v", "f")
    assert train.columns == [c for c, _ in TRAINING_COLUMNS] and train.count() == 24 * 11
    model, errors = fit_horizon(train, ["pm25_mean", "pm25_lag_1h", "hour_of_day", "season"], "pm25_next_6h", ["season"], trees=3, depth=2)
    assert {r["split"] for r in errors.collect()} == {"train", "validation", "test"}
    ranked = importance(spark, model)
    assert ranked.count() == 4 and abs(ranked.agg(F.sum("importance")).first()[0] - 1) < 1e-6
    assert predicted(model, train).count() == train.count()
    assert run_record(spark, "m", 6, errors, "p").first()["test_mae"] > 0
    registry = train_horizons(train, ["pm25_mean", "hour_of_day"], [6, 12], str(tmp_path), trees=2, depth=2)
    assert sorted(r["horizon_hours"] for r in registry.collect()) == [6, 12]
    assert predicted(newest_model(registry, "boosted_trees", 12), train).count() == train.count()
    assert csv_table(spark, f"{tmp_path}/boosted_trees_6h/importance", "feature string, importance double").count() == 2


def test_satellite_and_surface_silver(spark):
    cells = spark.createDataFrame([(T0, 21.0, 105.8, 1.0, 0.0, 200.0, 1e5, 300.0, 290.0, 0.001, 1e5)], "hour timestamp_ntz, lat double, lon double, u10 double, v10 double, blh double, sp double, t2m double, d2m double, tp double, msl double")
    r = surface_hourly(cells).first()
    assert (r["wind_dir"], r["low_pbl"], round(r["temperature_2m_c"], 2), r["total_precipitation_mm"]) == (270.0, True, 26.85, 1.0)
    px = spark.createDataFrame([("NO2", T0.date(), 21.0, 105.8, 1.0, 0.9, "b", T0), ("NO2", T0.date(), 21.0, 105.8, 3.0, 0.1, "a", T0), ("NO2", T0.date(), 21.0, 105.8, float("nan"), 0.9, "a", T0)], "product string, date date, lat double, lon double, value double, qa double, source_file string, overpass_time timestamp_ntz")
    assert [(r["valid_pct"], r["source_file"]) for r in swath_daily(px).collect()] == [(50.0, "a;b")] and round(swath_daily(px, count_all=True).first()["valid_pct"], 4) == 33.3333
    aod = spark.createDataFrame([(T0.date(), "f1", "t1", 0, 0, 1.0, 3.0, 0), (T0.date(), "f1", "t1", 0, 1, None, 5.0, 1), (T0.date(), "f2", "t1", 0, 0, 9.0, None, 0), (T0.date(), "f2", "t1", 0, 1, 7.0, 7.0, 3)], "date date, path string, tile string, row int, col int, aod_047 double, aod_055 double, qa int")
    r = aerosol_daily(aod).first()
    assert (r["aod_047_mean"], r["aod_mean"], r["valid_pixel_count"], r["total_pixel_count"], r["tile_count"], r["source_files"]) == (5.0, 6.0, 3, 4, 1, ["f1", "f2"])
    w = spark.createDataFrame([("e1", "Old Town", None, None, None, None, T0, T0), ("e2", "x", "r", "l", 50.0, 1.0, T0, T0)], "event_id string, province string, region string, location_name string, lat double, lon double, event_time timestamp_ntz, ingest_time timestamp_ntz")
    assert [r["event_id"] for r in weather_hourly(w, "old town").collect()] == ["e1"]


def test_clusters(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(c * 10 + rng.normal()), float(c * 5 + rng.normal())) for i, c in enumerate(np.repeat([0, 1, 2], 20))]
    df = spark.createDataFrame(rows, "id int, x double, y double")
    got = {r["id"]: r["cluster_id"] for r in clusters(df, ["x", "y"], k=3).collect()}
    assert all(len({got[i] for i in range(c * 20, c * 20 + 20)}) == 1 for c in range(3)) and len(set(got.values())) == 3
    assert {r["cluster_id"] for r in clusters(df.limit(1), ["x", "y"]).collect()} == {0}
    assert {r["cluster_id"] for r in clusters(df.withColumn("y", F.lit(None).cast("double")), ["x", "y"]).collect()} == {0}
    costs = cost_by_k(df, ["x", "y"], [2, 3])
    assert costs[1][1] < costs[0][1]


def test_compact_sums_lengths_in_spark(spark, tmp_path, monkeypatch):
    """No row of the list of files comes to the driver."""
    spark.range(100).repartition(20).write.parquet(f"{tmp_path}/small")
    monkeypatch.setattr(type(spark.range(1)), "toLocalIterator", lambda *_, **__: pytest.fail("rows come to the driver"))
    assert compact(spark, f"{tmp_path}/small")["files_after"] == 1 and spark.read.parquet(f"{tmp_path}/small").count() == 100


def test_compact_gives_each_partition_its_tasks(spark, tmp_path, monkeypatch):
    """Partitions, one of them null, do not share one task because all of them together are small, and a large one has several."""
    path = f"{tmp_path}/parts"
    rows = spark.range(8000).select("id", F.when(F.col("id") >= 4000, 0).when(F.col("id") >= 1000, (F.col("id") % 5 + 1).cast("int")).alias("y"))
    rows.repartition(8).write.partitionBy("y").parquet(path)
    dealt, whole = [], checks.replace_partitions
    monkeypatch.setattr(checks, "replace_partitions", lambda df, *rest: dealt.append(df.rdd.getNumPartitions()) or whole(df, *rest))
    report = compact(spark, path, ["y"])
    assert dealt == [7] and report["files_after"] <= 14 < report["files_before"]
    assert {(r["id"], r["y"]) for r in spark.read.parquet(path).collect()} == {tuple(r) for r in rows.collect()} and spark.read.parquet(path).count() == 8000
    compact(spark, path, ["y"], target_mb=0.005)
    assert dealt[1] > 8 and spark.read.parquet(path).count() == 8000
