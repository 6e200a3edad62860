"""Paged source in batch and as a stream that resumes; cubes planned in slabs."""

import json
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from aerolith.plans import source_queries
from aerolith.sources.cubes import MONTHS, Axes, Bounds, CubeReader, NpzCube, Variable, axes_of, decode_times, east, find_variable, real_values, register_cubes
from aerolith.sources.paged import PagedReader, PageStore, page_ranges, register_pages, write_pages
from aerolith.streaming.pipelines import append_to

SCHEMA = "id long, v double, tags array<string>, window string, page int"


def put(root, window, page, text, done=True):
    folder = root / f"window={window}" / f"page={page}"
    folder.mkdir(parents=True)
    (folder / "part-0.json").write_text(text)
    if done:
        (root / f"window={window}" / "_SUCCESS").write_text("")


def test_pages_in_batch(spark, tmp_path):
    put(tmp_path, "20240101", 1, json.dumps({"found": 3, "results": [{"id": 1, "v": 1.5, "tags": ["a"]}, {"id": 2, "other": 1}]}))
    put(tmp_path, "20240101", 2, json.dumps([{"id": 3, "v": 2}]))
    put(tmp_path, "20240101", 10, '{"id": 4}\n\n{"id": 5}\n')
    put(tmp_path, "20240102", 1, "[]")
    put(tmp_path, "20240103", 1, '[{"id": 6}]')
    put(tmp_path, "20240104", 1, '[{"id": 7}]', done=False)  # still being collected
    register_pages(spark)
    df = spark.read.format("pages").schema(SCHEMA).option("path", str(tmp_path)).option("pages_per_task", 2).load()
    got = sorted(df.collect())
    assert [(r["id"], r["window"], r["page"]) for r in got] == [(1, "20240101", 1), (2, "20240101", 1), (3, "20240101", 2), (4, "20240101", 10), (5, "20240101", 10), (6, "20240103", 1)]
    assert got[0]["tags"] == ["a"] and got[1]["v"] is None and got[2]["v"] == 2.0
    assert df.rdd.getNumPartitions() == 4
    late = df.where("window >= '20240102' and v is null")
    assert [r["id"] for r in late.collect()] == [6] and late.rdd.getNumPartitions() == 2  # windows before it are not planned
    assert [r["id"] for r in spark.read.format("pages").schema(SCHEMA).option("path", str(tmp_path)).option("start", "20240102").option("end", "20240103").load().collect()] == []
    assert spark.read.format("pages").schema(SCHEMA).option("path", str(tmp_path / "nothing")).load().count() == 0
    ranges = page_ranges(PageStore(str(tmp_path)), ["20240101"], 2)
    assert [(p.first, p.last) for p in ranges] == [(1, 2), (10, 10)]


def test_fetches_are_tried_again(tmp_path, monkeypatch):
    put(tmp_path, "w", 1, '[{"id": 1}]')
    store, calls = PageStore(str(tmp_path), attempts=3, wait_s=0.0), []
    opened = PageStore._opened

    def flaky(self):
        calls.append(1)
        if len(calls) < 3:
            raise OSError("reset")
        return opened(self)

    monkeypatch.setattr(PageStore, "_opened", flaky)
    assert store.fetch("w", 1) == [{"id": 1}] and len(calls) == 3
    calls[:] = [1] * -0
    monkeypatch.setattr(PageStore, "_opened", lambda self: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        store.fetch("w", 1)
    assert PagedReader(store, None, "b", "d", 1).tests == []


def test_stream_resumes_without_loss_or_repeats(spark, tmp_path):
    store, table, state = tmp_path / "store", str(tmp_path / "table"), str(tmp_path / "state")
    register_pages(spark)

    def run():
        stream = spark.readStream.format("pages").schema(SCHEMA).option("path", str(store)).option("start", "02").option("pages_per_task", 1).load()
        append_to(stream, table, state).awaitTermination()
        return sorted(r["id"] for r in spark.read.parquet(table).collect())

    put(store, "01", 1, '[{"id": 1}]')
    put(store, "02", 1, '[{"id": 2}]')
    put(store, "02", 2, '[{"id": 3}]')
    put(store, "03", 1, '[{"id": 4}]', done=False)
    assert run() == [2, 3]
    assert run() == [2, 3]
    put(store, "04", 1, '[{"id": 5}]', done=False)
    (store / "window=03" / "_SUCCESS").write_text("")
    assert run() == [2, 3, 4]
    (store / "window=04" / "_SUCCESS").write_text("")
    assert run() == [2, 3, 4, 5]


def test_written_pages_are_full(spark, tmp_path):
    rows = spark.range(25).select("id", F.when(F.col("id") < 13, "a").otherwise("b").alias("w"))
    write_pages(rows, str(tmp_path / "s"), "w", ["id"], 5)
    store = PageStore(str(tmp_path / "s"))
    assert store.windows() == ["a", "b"] and store.pages("a") == [1, 2, 3] == store.pages("b")
    assert [r["id"] for p in store.pages("a") for r in store.fetch("a", p)] == list(range(13)) and len(store.fetch("a", 3)) == 3


def test_tasks_list_no_window(tmp_path, monkeypatch):
    """A window is listed once, when its pages are dealt out; a task that listed it again would look at all pages for each few."""
    for n in range(1, 8):
        put(tmp_path, "w", n, json.dumps([{"id": n}]))
    reader = PagedReader(PageStore(str(tmp_path)), StructType([StructField("id", LongType()), StructField("page", LongType())]), None, None, 2)
    listed, whole = [], PageStore.pages
    monkeypatch.setattr(PageStore, "pages", lambda self, window: listed.append(window) or whole(self, window))
    parts = reader.partitions()
    got = [r["id"] for p in parts for batch in reader.read(p) for r in batch.to_pylist()]
    assert got == list(range(1, 8)) and len(parts) == 4 and listed == ["w"]


def test_stream_goes_on_with_half_of_the_days(spark, sf_dir, tmp_path, monkeypatch):
    """Copies with shifted keys come on the same days, so a half by keys leaves nothing for the second part (and its exact median held all keys in one task)."""
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    copies = rows.unionByName(rows.withColumn("event_id", F.col("event_id") + 1_000_000))
    copies.write.parquet(str(tmp_path / "events.parquet"))
    counts, write = [], source_queries.write_pages
    monkeypatch.setattr(source_queries, "write_pages", lambda part, *more: counts.append(part.count()) or write(part, *more))
    got = source_queries.paged_stream(spark, str(tmp_path))
    ids = sorted(r[0] for r in copies.select("event_id").collect())
    assert sorted(r[0] for r in got.select("event_id").collect()) == ids
    assert sum(counts) == len(ids) and 0.4 < counts[0] / len(ids) < 0.6


def test_few_tasks_read_many_ranges(spark, tmp_path):
    for n in range(1, 9):
        put(tmp_path / "store", "w", n, json.dumps([{"id": n}]))
    register_pages(spark)
    stream = spark.readStream.format("pages").schema(SCHEMA).option("path", str(tmp_path / "store")).option("pages_per_task", 1).load()
    append_to(stream, str(tmp_path / "table"), str(tmp_path / "state"), files=3).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "table")).collect()) == list(range(1, 9))
    assert len(list((tmp_path / "table").glob("*.parquet"))) == 3  # of eight ranges


def test_pages_show_when_they_are_whole(tmp_path):
    """A task that is tried again leaves a page that is in place; what a task did not finish is no page's record."""
    store = PageStore(str(tmp_path))
    store.put("w", 1, "part-a.json", ['{"id":1}', '{"id":2}'])
    (tmp_path / "window=w" / "page=1" / ".left").write_text('{"results":[{"id"')
    store.put("w", 1, "part-a.json", ['{"id":1}', '{"id":2}'])
    assert store.fetch("w", 1) == [{"id": 1}, {"id": 2}] and store.pages("w") == [1]
    store.put("w", 1, "part-b.json", ['{"id":3}'])
    assert [r["id"] for r in store.fetch("w", 1)] == [1, 2, 3]
    store.put("w", 2, "part-a.json", ['{"id":"a\u2028b\x85c"}'])
    assert store.fetch("w", 2) == [{"id": "a\u2028b\x85c"}]


def test_times_of_calendars():
    us = lambda *t: np.datetime64(datetime(*t), "us")
    assert decode_times([0, 1.5], "hours since 1900-01-01 00:00:0.0").tolist() == [datetime(1900, 1, 1), datetime(1900, 1, 1, 1, 30)]
    assert decode_times([86400], None)[0] == us(1970, 1, 2)
    assert decode_times([1], "days since 2000-2-28 12:00", "standard")[0] == us(2000, 2, 29, 12)
    assert decode_times([1], "days since 2000-02-28 12:00", "noleap")[0] == us(2000, 3, 1, 12)
    assert decode_times([1], "days since 1999-02-28", "366_day")[0].astype(str) == "NaT"
    assert decode_times([31, 58], "days since 2001-01-01", "360_day").astype("datetime64[D]").astype(str).tolist() == ["2001-02-02", "NaT"]
    assert decode_times([0], "seconds since 2024-05-01T02:00:00+02:00")[0] == us(2024, 5, 1)
    assert np.isnat(decode_times([float("nan"), 9e36], "days since 2000-01-01")).all()
    for year in (0, 1, 4, 100):
        assert decode_times([365 * year], "days since 1970-01-01", "365_day")[0] == us(1970 + year, 1, 1)
    assert sum(MONTHS) == 365
    for bad in (("fortnights since 2000-01-01", "standard"), ("days since 2000-01-01", "lunar")):
        with pytest.raises(ValueError):
            decode_times([0], *bad)


def test_search_axes_and_values():
    names = ["lat", "META/NO2", "PRODUCT/no2", "PRODUCT/DEEP/no2", "A/so2"]
    assert find_variable(names, ["no2"]) == "PRODUCT/no2" and find_variable(names, ["none", "SO2"]) == "A/so2" and find_variable(names, ["no2"], "META") == "META/NO2" and find_variable(names, ["x"]) is None
    assert axes_of(Variable(("Longitude", "time", "lat"), (4, 2, 3)), [2, 3, 4]) == [1, 2, 0]
    assert axes_of(Variable(("a", "b", "c"), (2, 3, 3)), [2, 3, 3]) == [0, 1, 2] and axes_of(Variable(("y", "x"), (3, 4)), [1, 3, 4]) == [None, 0, 1]
    out = real_values(np.array([1, -999, 5, 100, -1e31]), {"_FillValue": -999, "valid_range": [0, 50], "scale_factor": 2, "add_offset": 1})
    assert np.array_equal(out, [3, np.nan, 11, np.nan, np.nan], equal_nan=True)
    assert east(np.array([0.0, 180.0, 190.0, 359.5, -180.0])).tolist() == [0.0, -180.0, -170.0, -0.5, -180.0]


def write_cube(path, hours, value=lambda t, i, j: t * 100 + i * 10 + j, lat=(10.0, 11.0, 12.0), lon=(359.0, 0.0, 1.0, 2.0)):
    t = np.arange(len(hours))[:, None, None]
    x = value(t, np.arange(len(lat))[None, :, None], np.arange(len(lon))[None, None, :]).astype(float)
    with open(path, "wb") as f:
        NpzCube.save(f, {"time": (("time",), np.array(hours), {"units": "hours since 2024-01-01"}), "lat": (("lat",), np.array(lat), {}), "lon": (("lon",), np.array(lon), {}), "G/T2M": (("lon", "time", "lat"), x.transpose(2, 0, 1), {})})


def test_cube_slabs_are_skipped(spark, tmp_path):
    write_cube(tmp_path / "a.npz", range(0, 24))
    write_cube(tmp_path / "b.npz", range(24, 48))
    reader = CubeReader(str(tmp_path), NpzCube, {"t": ["temp", "t2m"], "none": ["q"]}, 12 * 6, r".*\.npz", 4)
    assert len(reader.plan(Bounds())) == 8
    register_cubes(spark)
    df = spark.read.format("cubes").option("path", str(tmp_path)).option("variables", '{"t": ["temp", "t2m"], "none": ["q"]}').option("cells", 72).option("pattern", r".*\.npz").load()
    rows = df.collect()
    assert len(rows) == 48 * 12 and df.rdd.getNumPartitions() == 8
    assert all(r["value"] == (r["time"].hour * 100 + r["row"] * 10 + r["col"]) and r["lat"] == 10 + r["row"] and r["lon"] == r["col"] - 1 for r in rows)
    some = df.where("time >= TIMESTAMP_NTZ'2024-01-02 20:00:00' and lon < 0.5 and lat = 11 and variable = 't'")
    assert sorted(r["value"] for r in some.collect()) == [h * 100 + 10 + j for h in range(20, 24) for j in (0, 1)]
    assert some.rdd.getNumPartitions() == 1  # of eight slabs
    assert df.where("variable = 'none'").count() == 0 == df.where("time > TIMESTAMP_NTZ'2030-01-01'").count()
    assert Axes(NpzCube(str(tmp_path / "a.npz"))).lengths == [24, 3, 4]


def test_swath_grids_and_extra_axes(spark, tmp_path):
    """Places on a grid of their own, no times, an axis of members, and all kinds of missing values."""
    lat, lon = np.meshgrid(np.arange(3.0), np.arange(2.0), indexing="ij")
    x = np.stack([np.full((3, 2), 4.0), np.array([[6, -999], [-999, 1e9], [0, 2]])])
    x[0, 0, 1] = -1e36
    with open(tmp_path / "s.npz", "wb") as f:
        NpzCube.save(f, {"PRODUCT/latitude": (("time", "y", "x"), lat[None], {}), "PRODUCT/longitude": (("time", "y", "x"), lon[None], {}), "PRODUCT/no2": (("time", "member", "y", "x"), x[None], {"_FillValue": -999, "valid_range": [-10, 100]})})
    register_cubes(spark)
    got = spark.read.format("cubes").option("path", str(tmp_path)).option("variables", '{"no2": ["no2"]}').load().orderBy("row", "col").collect()
    assert [r["time"] for r in got] == [None] * 6 and [(r["lat"], r["lon"]) for r in got] == [(i, j) for i in (0.0, 1.0, 2.0) for j in (0.0, 1.0)]
    assert np.array_equal([r["value"] for r in got], [5.0, np.nan, 4.0, 4.0, 2.0, 3.0], equal_nan=True)
