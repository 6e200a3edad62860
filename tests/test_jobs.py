from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith import jobs
from aerolith.operators.external import call_per_row, command
from aerolith.plans.registry import TABLES


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    t0 = datetime(2024, 3, 1)
    rows = [(f"{h}-{s}", s, 20.9 + 0.1 * s, 105.5 + 0.1 * s, s * 10, "pm25", float(h % 50 + s), 80.0, t0 + timedelta(hours=h), t0 + timedelta(hours=h)) for h in range(24 * 5) for s in range(4)]
    df = spark.createDataFrame(rows, "event_id string, location_id long, latitude double, longitude double, sensor_id long, parameter string, value double, coverage_pct double, event_time timestamp, ingest_time timestamp")
    fields = TABLES["sensor_bronze"].schema().fields
    df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields)).write.parquet(f"{path}/sensor_bronze")
    return path


def test_jobs_chain_and_rerun(spark, folder):
    for name in ("station_hourly_silver", "city_hourly_silver", "gradient_silver", "master_hourly_gold", "training_gold"):
        jobs.run(spark, name, folder)
        first = spark.read.parquet(f"{folder}/{name}").count()
        jobs.run(spark, name, folder)
        table = spark.read.parquet(f"{folder}/{name}")
        assert table.count() == first > 0 and set(table.columns) == set(TABLES[name].schema().fieldNames())
    assert spark.read.parquet(f"{folder}/master_hourly_gold").count() == 24 * 5
    assert spark.read.parquet(f"{folder}/training_gold").count() == 24 * 4
    day = spark.read.parquet(f"{folder}/city_hourly_silver")
    before = day.count()
    jobs.run(spark, "city_hourly_silver", folder, date(2024, 3, 2), date(2024, 3, 2), refresh=True)
    assert spark.read.parquet(f"{folder}/city_hourly_silver").count() == before
    gold = {r["hour"]: r for r in spark.read.parquet(f"{folder}/master_hourly_gold").collect()}
    for refresh in (False, True):  # a day built alone sees the days around it
        jobs.run(spark, "master_hourly_gold", folder, date(2024, 3, 3), date(2024, 3, 3), refresh=refresh)
        new = {r["hour"]: r for r in spark.read.parquet(f"{folder}/master_hourly_gold").collect()}
        assert len(new) == len(gold) and all(new[h][c] == gold[h][c] for h in gold for c in ("pm25_mean", "pm25_lag_24h", "pm25_next_24h", "pm25_roll_mean_24h"))
    with pytest.raises(SystemExit):
        jobs.main(["no_such_job", "--tables", folder])


def test_streams_fill_bronze(spark, tmp_path):
    """Two files of events, the second with a later row of a known event, a malformed line and one without a key; every bronze table parses its own times."""
    lines = [
        ['{"event_id": "a", "value": 1.5, "datetime_utc": "2024-03-01T05:00:00Z", "ingest_time": "2024-03-01T06:00:00Z"}', '{"event_id": "b", "value": 2, "datetime_utc": "2024-03-02T05:30:00+07:00", "ingest_time": "2024-03-02T06:00:00Z"}'],
        ['{"event_id": "b", "value": 9, "datetime_utc": "2024-03-01T22:30:00Z", "ingest_time": "2024-03-03T06:00:00Z"}', "no json", '{"value": 3, "datetime_utc": "2024-03-01T22:30:00Z"}'],
    ]
    for i, part in enumerate(lines):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{i}.json").write_text("\n".join(part))
        jobs.main(["sensor_bronze", "--tables", str(tmp_path / "t"), "--events", str(tmp_path / "in")])
    table = spark.read.parquet(str(tmp_path / "t" / "sensor_bronze"))
    assert {r["event_id"]: (r["value"], r["event_time"], r["day"], r["hour"]) for r in table.collect()} == {"a": (1.5, datetime(2024, 3, 1, 5), 1, 5), "b": (9.0, datetime(2024, 3, 1, 22, 30), 1, 22)}
    assert set(table.columns) == set(TABLES["sensor_bronze"].schema().fieldNames())
    others = {"weather_bronze": '{"event_id": "w", "time": "2024-03-01 05:00"}', "swath_bronze": '{"event_id": "s", "product": "NO2", "content_start": "2024-03-01T05:00:00.000Z"}', "granule_bronze": '{"event_id": "g", "short_name": "M", "tile": "h", "acquisition_date": "2024-03-01 05:00:00"}', "reanalysis_files_bronze": '{"event_id": "r", "dataset_type": "single", "year": 2024, "month": 3, "start_time": "2024-03-01T05:00:00Z", "end_time": "2024-03-31T23:00:00Z"}'}
    for name, line in others.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "e.json").write_text(line)
        jobs.main([name, "--tables", str(tmp_path / "t"), "--events", str(tmp_path / name)])
        row = spark.read.parquet(str(tmp_path / "t" / name)).first().asDict()
        assert row.get("event_time", row.get("start_time")) == datetime(2024, 3, 1, 5) and (row["year"], row["month"]) == (2024, 3)
    with pytest.raises(SystemExit):
        jobs.main(["sensor_bronze", "--tables", str(tmp_path)])


def test_satellite_and_trajectory_jobs(spark, folder, tmp_path):
    from aerolith.sources.cubes import NpzCube

    root = str(tmp_path)
    (tmp_path / "surface_cubes").mkdir()
    lat, lon = [20.8, 21.0, 30.0], [105.5, 105.9]
    shape = (2, 3, 2)
    fields = {n: (("time", "lat", "lon"), np.full(shape, v), {}) for n, v in {"10m_u_component_of_wind": 3.0, "v10": 4.0, "blh": 200.0, "sp": 1000.0, "T2M": 300.0, "d2m": 10.0, "tp": 0.001, "msl": 1010.0}.items()}
    with open(tmp_path / "surface_cubes" / "a.npz", "wb") as f:
        NpzCube.save(f, {"time": (("time",), np.arange(2), {"units": "hours since 2024-03-01"}), "lat": (("lat",), np.array(lat), {}), "lon": (("lon",), np.array(lon), {}), **fields})
    jobs.run(spark, "surface_hourly_silver", root)
    row = spark.read.parquet(f"{root}/surface_hourly_silver").orderBy("hour").first()
    assert (row["hour"], row["wind_speed"], row["low_pbl"], row["temperature_2m_c"], row["total_precipitation_mm"], row["grid_point_count"]) == (datetime(2024, 3, 1), 5.0, True, pytest.approx(26.85), 1.0, 4)

    pixels = [("NO2", date(2024, 3, 1 + d), datetime(2024, 3, 1 + d, 6), f"f{d}", 20.7 + 0.01 * i, 105.5, float(i), 0.9 if i % 4 else 0.1) for d in range(3) for i in range(20)]
    spark.createDataFrame(pixels, "product string, date date, overpass_time timestamp, source_file string, lat double, lon double, value double, qa double").write.parquet(f"{root}/swath_pixels")
    for name in ("swath_daily_silver", "pixel_grid_silver"):
        jobs.run(spark, name, root)
        jobs.run(spark, name, root, date(2024, 3, 2), date(2024, 3, 2))
    daily, grid = spark.read.parquet(f"{root}/swath_daily_silver").collect(), spark.read.parquet(f"{root}/pixel_grid_silver")
    assert len(daily) == 3 and {(r["valid_pixel_count"], r["total_pixel_count"], r["value_max"]) for r in daily} == {(15, 20, 19.0)}
    assert grid.count() == 45 and {r["valid_pct"] for r in grid.collect()} == {75.0}
    aod = [(date(2024, 3, 1), "p", "h27v06", i, 0, 1, 0.1 * i, 0.2 * i) for i in range(4)]
    spark.createDataFrame(aod, "date date, path string, tile string, row int, col int, qa int, aod_047 double, aod_055 double").write.parquet(f"{root}/aerosol_pixels")
    jobs.run(spark, "aerosol_daily_silver", root)
    assert spark.read.parquet(f"{root}/aerosol_daily_silver").first()["aod_max"] == pytest.approx(0.6)

    city = [(datetime(2024, 3, 1) + timedelta(hours=h), 80.0 if h == 5 else 10.0) for h in range(24)]
    target = TABLES["city_hourly_silver"].schema()
    hours = spark.createDataFrame(city, "hour timestamp, pm25_mean double")
    hours.select(*((F.col(f.name) if f.name in hours.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in target)).write.parquet(f"{root}/city_hourly_silver")
    jobs.run(spark, "runs_bronze", root)
    runs = spark.read.parquet(f"{root}/runs_bronze")
    assert runs.groupBy("direction").count().orderBy("direction").collect() == [("backward", 27), ("forward", 4 * 27)]
    one = runs.where("direction = 'backward'").orderBy("run_id").first()
    (tmp_path / "dump_files").mkdir()
    (tmp_path / "dump_files" / one["output_path"].rpartition("/")[2]).write_text("1 1 24 3 1 5 0 0 0.0 21.0 105.8 100.0\n1 1 24 3 1 4 0 0 -1.0 21.1 105.7 110.0\n")
    runs.where(F.col("run_id") == one["run_id"]).withColumn("status", F.lit("success")).write.parquet(f"{root}/done")
    (tmp_path / "runs_bronze").rename(tmp_path / "planned")
    (tmp_path / "done").rename(tmp_path / "runs_bronze")
    jobs.run(spark, "trajectory_points_silver", root)
    points = spark.read.parquet(f"{root}/trajectory_points_silver").orderBy("age_h").collect()
    assert [(r["age_h"], r["lat"], r["timestamp"]) for r in points] == [(-1, 21.1, datetime(2024, 3, 1, 4)), (0, 21.0, datetime(2024, 3, 1, 5))]
    assert set(jobs.JOBS) | set(jobs.STREAMS) | {"meteo_files_bronze", "model_runs_gold"} == set(TABLES)


def test_external_calls(spark):
    df = spark.createDataFrame([(1, "ok"), (2, "bad")], "id int, word string")
    rows = {r["id"]: r for r in call_per_row(df, command(lambda r: ["sh", "-c", "echo hi" if r["word"] == "ok" else "echo no >&2; exit 3"]), "output string", ["id"]).collect()}
    assert (rows[1]["output"], rows[1]["status"]) == ("hi\n", "success")
    assert rows[2]["status"] == "failed" and "exit 3: no" in rows[2]["error_message"] and rows[2]["output"] is None
