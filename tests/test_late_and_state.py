"""Late rebuilds, metric log, keyed state, programs: against full builds and plain counts."""

import sys
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aerolith.checks.metrics import LOG, ProgressLog, latest_metrics, standard_metrics, write_measured
from aerolith.operators.programs import Program, attempted, pending, run_programs
from aerolith.operators.series import feature_columns, over_hours
from aerolith.plans.incremental import Mark, rebuild_late
from aerolith.plans.source_queries import stateful_latest
from aerolith.sinks.upsert import upsert
from aerolith.streaming import latest
from aerolith.streaming.latest import latest_changes, state_rows, upsert_changes, use_state_store

T0 = datetime(2024, 1, 1)


def features(rows):
    columns = feature_columns("v", "p", (1, 24), (3,), (6,))
    return over_hours(rows, "hour", columns, 24).select("hour", "v", *columns)


def hourly(rows):
    return rows.groupBy("hour").agg(F.avg("value").alias("v"))


def source(spark, rows):
    df = spark.createDataFrame(rows, "ts timestamp_ntz, value double, at timestamp_ntz")
    return df.withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))


def table(spark, path):
    return sorted((tuple(r) for r in spark.read.parquet(path).drop("part").collect()), key=str)


def written_days(path, since):
    return {f.parent.name.removeprefix("part=") for f in path.rglob("*.parquet") if f.stat().st_mtime_ns > since}


def test_late_rows_rebuild_only_what_they_change(spark, tmp_path):
    day1, day2 = datetime(2024, 5, 1), datetime(2024, 5, 2)
    first = [(T0 + timedelta(minutes=37 * i), float(i % 11), day1) for i in range(24 * 40)]
    run = lambda rows, name: rebuild_late(source(spark, rows), str(tmp_path / name), str(tmp_path / f"{name}-mark"), hourly, features, "ts", "at", 24, 6)
    whole = run(first, "a")
    assert whole.new_rows == len(first) and whole.hours == (first[-1][0] - T0) // timedelta(hours=1) + 1
    assert run(first, "a").hours == 0  # nothing new
    since = time.time_ns()
    late = [(datetime(2024, 1, 10, 14, 5), 99.0, day2), (datetime(2024, 1, 10, 15, 5), 50.0, day2)]
    done = run(first + late, "a")
    run(first + late, "full")
    assert table(spark, str(tmp_path / "a")) == table(spark, str(tmp_path / "full"))
    # From six hours before the first late hour to a day after the last.
    assert done.new_rows == 2 and done.hours == 6 + 2 + 24 and done.partitions == 2
    assert written_days(tmp_path / "a", since) == {"2024-01-10", "2024-01-11"}


def test_rows_beyond_both_ends_and_far_apart(spark, tmp_path):
    marks = [datetime(2024, 6, d) for d in (1, 2, 3)]
    rows = [(T0 + timedelta(hours=5 * i), float(i), marks[0]) for i in range(30)]
    rows += [(T0 - timedelta(hours=40), 7.0, marks[1]), (T0 + timedelta(days=20), 8.0, marks[1]), (None, 1.0, marks[1]), (T0, 1.0, None)]
    rows += [(T0 + timedelta(days=20), 10.0, marks[2]), (T0 + timedelta(days=9), 3.0, marks[2])]
    for n in (1, 2, 3):
        seen = [r for r in rows if r[2] is None or r[2] <= marks[n - 1]]
        rebuild_late(source(spark, seen), str(tmp_path / "a"), str(tmp_path / "mark"), hourly, features, "ts", "at", 24, 6)
        rebuild_late(source(spark, seen), str(tmp_path / f"full{n}"), str(tmp_path / f"mark{n}"), hourly, features, "ts", "at", 24, 6)
        assert table(spark, str(tmp_path / "a")) == table(spark, str(tmp_path / f"full{n}"))
    mark = Mark.load(spark, str(tmp_path / "mark"))
    assert mark == Mark(marks[2], datetime(2023, 12, 30, 8), T0 + timedelta(days=20)) and Mark.load(spark, str(tmp_path / "no")) is None


def test_upsert_computes_its_source_once(spark, tmp_path):
    for _ in range(2):  # a new table, then one that is there
        seen = spark.sparkContext.accumulator(0)

        def count(batches, seen=seen):
            for pdf in batches:
                seen.add(len(pdf))
                yield pdf

        upsert(spark.range(100).withColumn("d", F.col("id") % 3).mapInPandas(count, "id long, d long"), str(tmp_path / "t"), ["id"], ["d"])
        assert seen.value == 100
    with pytest.raises(ValueError):
        upsert(spark.range(3).select(F.lit(1).alias("id"), F.lit(0).cast("long").alias("d")), str(tmp_path / "t"), ["id"], ["d"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100 and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_metrics_come_from_the_pass_that_writes(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    rows = spark.range(1000).select("id", F.when(F.col("id") % 4 > 0, F.col("id") * 1.0).alias("v")).mapInPandas(count, "id long, v double")
    got = write_measured(rows, lambda df: upsert(df, str(tmp_path / "t"), ["id"]), standard_metrics(rows, ["v"], None, {"large": F.col("v") > 500}), "t", str(tmp_path / "log"))
    assert seen.value == 1000
    assert got == {"rows": 1000, "null_ratio_v": 0.25, "min_v": 1.0, "max_v": 999.0, "large": 375}
    log = {r["metric"]: r["value"] for r in latest_metrics(spark, str(tmp_path / "log")).collect()}
    assert log == {k: float(v) for k, v in got.items()}
    empty = write_measured(rows.where("false"), lambda df: df.write.parquet(str(tmp_path / "e")), standard_metrics(rows, ["v"]), "e", str(tmp_path / "log"))
    assert empty["rows"] == 0 and empty["max_v"] is None

    def broken(df):
        raise OSError("disk")

    with pytest.raises(OSError):
        write_measured(rows, broken, standard_metrics(rows, []), "x", str(tmp_path / "log"))
    assert spark.read.schema(LOG).parquet(str(tmp_path / "log")).where("table = 'x'").count() == 0


def test_rates_are_by_offsets_and_never_below_zero():
    now = iter([0.0, 2.0, 4.0, 5.0])
    log = ProgressLog(lambda: next(now))
    log.sample("s", 0, 100, {})
    log.sample("s", 1, 50, {"seen.high": 3})
    log.sample("s", 1, 60, {})  # the same batch reported again
    log.sample("s", 1, 20, {})  # and corrected downwards
    waiting = [log._waiting[("s", b)] for b in (0, 1)]
    assert waiting[0]["rows_per_second"] == 0.0 and waiting[1] == {"batch": 1, "rows": 20, "rows_per_second": 0.0}
    now = iter([0.0, 2.0])
    log = ProgressLog(lambda: next(now))
    log.sample("s", 0, 100, {})
    log.sample("s", 1, 50, {})
    assert log._waiting[("s", 1)]["rows_per_second"] == 25.0


def test_state_sends_changes_and_is_dropped(spark, tmp_path):
    use_state_store(spark)
    schema = "k int, ts timestamp, id int, v string"
    at = lambda h: datetime(2024, 1, 1) + timedelta(hours=h)
    batches = [
        [(1, at(0), 1, "a"), (1, at(1), 2, "b"), (2, at(0), 3, "c"), (None, at(0), 4, "x"), (3, None, 5, "x")],
        [(1, at(1), 2, "b"), (2, at(0), 2, "old"), (2, at(0.5), 9, "d"), (1, at(0.9), 99, "older")],  # again, older by the tie's breaker, newer, older
        [(5, at(90), 6, "e")],
        [(6, at(91), 7, "f"), (1, at(2), 8, "behind the watermark")],
    ]
    sent, states = [], []
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        changes = latest_changes(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), ["k"], "ts", ["ts", "id"], "2 hours", keep_ms=3_600_000)
        kept = tmp_path / f"sent{len(sent)}"
        query = changes.writeStream.outputMode("update").foreachBatch(lambda df, n, kept=kept: df.write.mode("append").parquet(str(kept))).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
        sent.append(sorted(r["v"] for r in spark.read.schema(schema).parquet(str(kept)).collect()))
        states += state_rows(query)
    assert sent == [["b", "c"], ["d"], ["e"], ["f"]]
    assert states[-1][0] <= 2  # the keys of the first day are gone

    final = latest_changes(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), ["k"], "ts", ["ts", "id"], "1000 hours")
    upsert_changes(final, str(tmp_path / "table"), str(tmp_path / "state2"), ["k"]).awaitTermination()
    assert {r["k"]: r["v"] for r in spark.read.parquet(str(tmp_path / "table")).collect()} == {1: "behind the watermark", 2: "d", 5: "e", 6: "f"}


def test_keys_with_their_hour_need_no_python(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(latest, "LatestRow", None)  # no call for each key
    use_state_store(spark)
    schema = "k int, hour timestamp, ts timestamp, id int, v string"
    row = lambda k, h, minute, i, v: (k, T0 + timedelta(hours=h), None if minute is None else T0 + timedelta(hours=h, minutes=minute), i, v)
    batches = [
        [row(1, 0, 10, 1, "a"), row(1, 0, 20, 2, "b"), row(2, 0, 10, 3, "c"), row(None, 0, 1, 4, "x"), (3, None, T0, 5, "x")],
        [row(1, 0, 20, 2, "again"), row(2, 0, 5, 9, "older"), row(2, 0, 10, 4, "d"), row(1, 1, 0, 5, "e"), row(1, 0, None, 9, "no time"), row(4, 1, None, 1, "first")],
        [row(5, 90, 0, 6, "f")],
        [row(6, 91, 0, 7, "g"), row(1, 0, 50, 8, "behind the watermark")],
    ]
    sent, states = [], []
    for rows in batches:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "in"))
        changes = latest_changes(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), ["k", "hour"], "hour", ["ts", "id"], "2 hours")
        assert changes.columns == ["k", "hour", "ts", "id", "v"]
        kept = tmp_path / f"sent{len(sent)}"
        query = changes.writeStream.outputMode("update").foreachBatch(lambda df, n, kept=kept: df.write.mode("append").parquet(str(kept))).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
        sent.append(sorted(r["v"] for r in spark.read.schema(schema).parquet(str(kept)).collect()))
        states += state_rows(query)
    assert sent == [["b", "c"], ["d", "e", "first"], ["f"], ["g"]]
    assert states[-1][0] <= 2  # the keys of the first day are gone
    assert stateful_latest(spark, "/root/testdata/sf0.001").count() > 900


ECHO = """
import json, sys, time, os
for line in sys.stdin:
    r = json.loads(line)
    if r['v'] == 'hang': time.sleep(60)
    if r['v'] == 'die': os._exit(3)
    if r['v'] == 'no json': print('oops', flush=True); continue
    if r['v'] == 'error': print(json.dumps({'error': 'bad row'}), flush=True); continue
    if r['v'] == 'kind': print(json.dumps({'n': 'text'}), flush=True); continue
    if r['v'] == 'once':
        mark = os.environ['MARK']
        if not os.path.exists(mark): open(mark, 'w').close(); os._exit(1)
    print(json.dumps({'n': len(r['v']), 'pid': os.getpid()}), flush=True)
"""
CALL = [sys.executable, "-c", ECHO]


def test_programs_live_as_long_as_their_task(spark, tmp_path):
    rows = spark.createDataFrame([(i, "x" * i) for i in range(40)], "id int, v string").coalesce(1)
    got = attempted(rows, CALL, "n int, pid long", ["id"]).collect()
    assert [(r["id"], r["n"], r["status"], r["attempt"]) for r in got] == [(i, i, "success", 1) for i in range(40)] and len({r["pid"] for r in got}) == 1
    long = attempted(spark.createDataFrame([(1, "é" * 3_000_000)], "id int, v string"), CALL, "n int", ["id"]).collect()
    assert long[0]["n"] == 3_000_000
    assert attempted(rows.limit(0), ["/no/such/program"], "n int", ["id"]).collect() == []


def test_failing_and_hanging_rows(spark, tmp_path):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(["ok", "hang", "die", "no json", "error", "kind", "once", "fine"])], "id int, v string").coalesce(1)
    path, env = str(tmp_path / "attempts"), {"MARK": str(tmp_path / "mark")}
    run = lambda most=3: {r["id"]: r for r in run_programs(rows, path, CALL, "n int", ["id"], timeout_s=3.0, most=most, env=env).collect()}
    first = run()
    assert {i: r["status"] for i, r in first.items()} == {0: "success", 1: "timeout", 2: "failed", 3: "failed", 4: "failed", 5: "failed", 6: "failed", 7: "success"}
    assert first[4]["error"] == "bad row" and "ended with 3" in first[2]["error"] and first[5]["n"] is None and 2.5 < first[1]["seconds"] < 20
    second = run()
    assert second[6]["status"] == "success" and second[6]["attempt"] == 2 and second[0]["attempt"] == 1 and second[1]["attempt"] == 2
    table = spark.read.parquet(path)
    assert table.count() == 8 + 6 and pending(rows, table, ["id"], 3).count() == 5 and pending(rows, table, ["id"], 2).count() == 0
    assert run(2)[1]["attempt"] == 2  # spent


def test_a_program_that_will_not_start(spark):
    with pytest.raises(OSError):
        Program(["/no/such/program"]).ask(b"{}", 1.0)
