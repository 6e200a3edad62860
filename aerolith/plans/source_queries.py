"""Registered queries of sources, streams and joins that have a mechanism of their own: pages, cubes, late rows, metrics, polygons, state, programs."""

from __future__ import annotations

import sys
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.checks.metrics import ProgressLog, latest_metrics, standard_metrics, write_measured
from aerolith.operators.polygons import counts_in_polygons
from aerolith.operators.programs import run_programs
from aerolith.operators.series import feature_columns, over_hours, ranked
from aerolith.plans.incremental import rebuild_late
from aerolith.plans.queries import ERRORS, LAT, LON, events, query, rounded, table
from aerolith.shared import shared_folder, staged
from aerolith.sinks.upsert import upsert
from aerolith.sources.cubes import NpzCube, register_cubes
from aerolith.sources.paged import register_pages, write_pages
from aerolith.streaming.latest import latest_changes, upsert_changes, use_state_store
from aerolith.streaming.pipelines import append_to

EVENT_PAGES = "event_id long, ts string, user_id long, event_type string, value double, window string, page int"


def _records(spark, sf_dir: str) -> DataFrame:
    """Events as a service's records, each in the window of its day."""
    rows = table(spark, sf_dir, "events")
    return rows.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "user_id", "event_type", "value", F.date_format("ts", "yyyyMMdd").alias("day"))


def _typed(pages: DataFrame) -> DataFrame:
    return pages.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "window")


@query("SELECT event_id, ts, user_id, event_type, value, strftime(ts, '%Y%m%d') AS window FROM events")
def paged_events(spark, sf_dir):
    """Pages of a day's events each, read page range by page range."""
    folder = shared_folder(spark, "pages")
    write_pages(_records(spark, sf_dir), folder, "day", ["ts", "event_id"], 250)
    register_pages(spark)
    return _typed(spark.read.format("pages").schema(EVENT_PAGES).option("path", folder).option("pages_per_task", 4).load())


def _half_way(rows: DataFrame, day: str) -> str | None:
    """The day by whose end half of the rows have come, from counts by day; a median of the rows' own numbers would hold each of them in one task."""
    counts = rows.where(F.col(day).isNotNull()).groupBy(day).count().orderBy(day).collect()  # one row a day
    come = list(accumulate(r["count"] for r in counts))
    return next((r[day] for r, n in zip(counts, come, strict=True) if 2 * n >= come[-1]), None)


@query("SELECT event_id, ts, user_id, event_type, value, strftime(ts, '%Y%m%d') AS window FROM events")
def paged_stream(spark, sf_dir):
    """The same by a stream that ends, with windows that come after, and goes on where it was."""
    folder = shared_folder(spark, "pages")
    register_pages(spark)
    records = staged(_records(spark, sf_dir))
    last = _half_way(records, "day")
    for part in (F.col("day") <= last, F.col("day") > last):
        write_pages(records.where(part), f"{folder}/store", "day", ["ts", "event_id"], 250)
        stream = spark.readStream.format("pages").schema(EVENT_PAGES).option("path", f"{folder}/store").option("pages_per_task", 4).load()
        append_to(_typed(stream), f"{folder}/table", f"{folder}/state", files=int(spark.conf.get("spark.sql.shuffle.partitions"))).awaitTermination()
    return spark.read.parquet(f"{folder}/table")


def _features(rows: DataFrame) -> DataFrame:
    columns = feature_columns("v", "p", (1, 24), (3, 24), (6, 24))
    return over_hours(rows, "hour", columns, 24).select("hour", "v", *columns)


@query(f"""WITH {ERRORS} SELECT hour, round(v, 6) AS v, {', '.join(f'round(lag(v, {n}) OVER w, 6) AS p_lag_{n}h' for n in (1, 24))}, {', '.join(f'round(avg(v) OVER (ORDER BY hour ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), 9) AS p_roll_mean_{n}h' for n in (3, 24))},
round(max(v) OVER (ORDER BY hour ROWS BETWEEN 23 PRECEDING AND CURRENT ROW), 6) AS p_roll_max_24h, round(stddev_samp(v) OVER (ORDER BY hour ROWS BETWEEN 23 PRECEDING AND CURRENT ROW), 7) AS p_roll_std_24h,
{', '.join(f'round(lead(v, {n}) OVER w, 6) AS p_next_{n}h' for n in (6, 24))} FROM series WINDOW w AS (ORDER BY hour)""")
def late_rebuild(spark, sf_dir):
    """Hours with lags and leads, built when most events had come and rebuilt where the late ones change them: equal to one full build."""
    folder = shared_folder(spark, "late")
    rows = events(spark, sf_dir).where("event_type = 'error'")
    # The events of a few hours, and the last ones, come a day later.
    late = (F.dayofmonth("ts") % 7 == 3) & (F.hour("ts") == 5) | (F.col("event_id") % 50 == 7)
    rows = rows.withColumn("ingested", F.when(late, F.lit("2025-02-01").cast("timestamp_ntz")).otherwise(F.lit("2025-01-01").cast("timestamp_ntz")))
    hourly = lambda df: df.groupBy("hour").agg(F.avg("value").alias("v"))
    for seen in (rows.where("ingested < TIMESTAMP_NTZ'2025-02-01'"), rows):
        rebuild_late(seen, f"{folder}/gold", f"{folder}/mark", hourly, _features, "ts", "ingested", 24, 24)
    out = spark.read.parquet(f"{folder}/gold").drop("part")
    digits = {c: 9 if "mean" in c else 7 if "std" in c else 6 for c in out.columns if c != "hour"}
    return out.select("hour", *(F.round(c, d).alias(c) for c, d in digits.items()))


def write_cubes(spark, sf_dir: str, folder: str) -> None:
    """A file a day with the mean value of each hour and place on a grid, in hours since 2000 by latitude, member and longitude, stored as scaled numbers."""
    rows = events(spark, sf_dir)
    cells = rows.groupBy(F.date_format("ts", "yyyyMMdd").alias("day"), F.hour("ts").alias("h"), F.expr("user_id % 17").alias("i"), F.expr("user_id % 13").alias("j")).agg(F.avg("value").alias("v"))

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        day = pdf["day"][0]
        x = np.full((24, 17, 2, 13), -9999.0)
        for k, sign in enumerate((-1, 1)):  # two members whose mean is the value
            x[pdf["h"], pdf["i"], k, pdf["j"]] = pdf["v"] * 4 + sign
        start = (np.datetime64(f"{day[:4]}-{day[4:6]}-{day[6:]}", "h") - np.datetime64("2000-01-01", "h")).astype(int)
        files, root = pafs.FileSystem.from_uri(folder)
        files.create_dir(root, recursive=True)
        arrays = {
            "valid_time": (("valid_time",), start + np.arange(24), {"units": "hours since 2000-01-01", "calendar": "proleptic_gregorian"}),
            "DATA/Latitude": (("latitude",), 20.55 + np.arange(17) * 0.06, {}),
            "DATA/longitude": (("longitude",), 105.2 + np.arange(13) * 0.08, {}),
            "DATA/MEAN_VALUE": (("valid_time", "latitude", "member", "longitude"), x, {"_FillValue": -9999.0, "scale_factor": 0.25}),
        }
        with files.open_output_stream(f"{root}/cube_{day}.npz") as out:
            NpzCube.save(out, arrays)
        return pd.DataFrame({"day": [day]})

    cells.groupBy("day").applyInPandas(write, "day string").count()  # at most 24 x 221 rows a day


@query("SELECT hour, lat, lon, round(avg(value), 6) AS value FROM (SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, (user_id % 17)::INT AS lat, (user_id % 13)::INT AS lon, value FROM events) GROUP BY 1, 2, 3")
def cube_values(spark, sf_dir):
    folder = shared_folder(spark, "cubes")
    write_cubes(spark, sf_dir, folder)
    register_cubes(spark)
    found = spark.read.format("cubes").option("path", folder).option("variables", '{"v": ["value", "mean_value"]}').option("cells", 2000).load()
    return found.where(~F.isnan("value")).select(F.col("time").alias("hour"), F.col("row").alias("lat"), F.col("col").alias("lon"), F.round("value", 6).alias("value"))


@query("""SELECT hour, lat, lon, round(avg(value), 6) AS value FROM (SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, (user_id % 17)::INT AS lat, (user_id % 13)::INT AS lon, value FROM events)
WHERE hour >= (SELECT date_trunc('day', max(ts)) FROM events) AND 20.55 + lat * 0.06 >= 21 GROUP BY 1, 2, 3""")
def cube_window(spark, sf_dir):
    """The last day's northern half: bounds of time and place choose the slabs."""
    folder = shared_folder(spark, "cubes")
    write_cubes(spark, sf_dir, folder)
    register_cubes(spark)
    found = spark.read.format("cubes").option("path", folder).option("variables", '{"v": ["value", "mean_value"]}').option("cells", 2000).load()
    day = table(spark, sf_dir, "events").agg(F.date_trunc("day", F.max("ts")).cast("timestamp_ntz").cast("string")).first()[0]
    found = found.where((F.col("time") >= F.lit(day).cast("timestamp_ntz")) & (F.col("lat") >= 21.0) & ~F.isnan("value"))
    return found.select(F.col("time").alias("hour"), F.col("row").alias("lat"), F.col("col").alias("lon"), F.round("value", 6).alias("value"))


@query("""SELECT m AS metric, round(v, 6) AS value, t AS text FROM (WITH w AS (SELECT date_trunc('hour', ts) AS hour, avg(value) AS v, max(CASE WHEN value < 200 THEN value END) AS low FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT unnest(['rows', 'null_ratio_v', 'min_v', 'max_v', 'null_ratio_low', 'min_low', 'max_low', 'first', 'last', 'high']) AS m,
unnest([count(*)::DOUBLE, 0, min(v), max(v), avg((low IS NULL)::INT), min(low), max(low), NULL, NULL, count(*) FILTER (v >= 75)]) AS v,
unnest([NULL, NULL, NULL, NULL, NULL, NULL, NULL, strftime(min(hour), '%Y-%m-%d %H:%M:%S'), strftime(max(hour), '%Y-%m-%d %H:%M:%S'), NULL]) AS t FROM w)""")
def written_metrics(spark, sf_dir):
    """Metrics of the rows that an upsert wrote, from the pass that wrote them."""
    folder = shared_folder(spark, "metrics")
    low = F.max(F.when(F.col("value") < 200, F.col("value")))
    rows = events(spark, sf_dir).where("event_type = 'error'").groupBy("hour").agg(F.avg("value").alias("v"), low.alias("low"))
    metrics = standard_metrics(rows, ["v", "low"], "hour", {"high": F.col("v") >= 75})
    write_measured(rows, lambda df: upsert(df, f"{folder}/table", ["hour"]), metrics, "air", f"{folder}/log")
    return rounded(latest_metrics(spark, f"{folder}/log").select("metric", "value", "text"), "value")


@query("SELECT count(*)::BIGINT AS rows, count(*) FILTER (value >= 75) AS high, true AS rates_ok FROM events")
def stream_metrics(spark, sf_dir):
    """Progress of a stream as rows of the log: what came in, and what its batches observed."""
    folder = shared_folder(spark, "progress")
    listener = ProgressLog()
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parque[t]")
        stream = stream.observe("seen", F.count_if(F.col("value") >= 75).alias("high"))
        run = append_to(stream, f"{folder}/table", f"{folder}/state")
        run.awaitTermination()
        listener.drain(str(run.id), 60)
        listener.flush(spark, f"{folder}/log")
    finally:
        spark.streams.removeListener(listener)
    value = lambda name: F.sum(F.when(F.col("metric") == name, F.col("value")))
    log = spark.read.parquet(f"{folder}/log").where(F.col("table") == str(run.id))
    return log.agg(value("rows").cast("long").alias("rows"), value("seen.high").cast("long").alias("high"), F.coalesce(F.min(F.when(F.col("metric") == "rows_per_second", F.col("value"))) >= 0, F.lit(False)).alias("rates_ok"))


@query("SELECT event_id, row_number() OVER (ORDER BY ts::DATE, event_id DESC) AS rank, count(*) OVER () AS total FROM events")
def event_ranks(spark, sf_dir):
    """Numbers of all rows in an order with many ties."""
    rows = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("date").alias("day"), (-F.col("event_id")).alias("back"))
    return ranked(rows, "day", ties=["back"]).select("event_id", "rank", "total")


#: A supplier's area: an uneven ring of five corners around a place, and a hole of four in it.
_CORNERS = [[(-0.21, -0.1), (-0.05, 0.3), (0.17, 0.22), (0.3, -0.03), (0.04, -0.27)], [(-0.06, -0.04), (0.02, 0.08), (0.09, 0.01), (0.01, -0.09)]]


def _area_sql() -> str:
    sides = [(*a, *b) for ring in _CORNERS for a, b in zip(ring, [*ring[1:], ring[0]], strict=True)]
    return "[" + ", ".join(f"[{', '.join(f'{v}::DOUBLE' for v in s)}]" for s in sides) + "]"


@query(f"""WITH areas AS (SELECT s_suppkey, 20.5::DOUBLE + (s_suppkey % 23) * 0.05::DOUBLE AS y, 105.1::DOUBLE + (s_suppkey % 29) * 0.04::DOUBLE AS x, 0.5::DOUBLE + (s_suppkey % 5) * 0.25::DOUBLE AS k, unnest({_area_sql()}) AS e FROM supplier),
edges AS (SELECT s_suppkey, y + k * e[1] AS y1, x + k * e[2] AS x1, y + k * e[3] AS y2, x + k * e[4] AS x2 FROM areas),
places AS (SELECT {LAT}::DOUBLE AS lat, {LON}::DOUBLE AS lon, count(*) AS n FROM events GROUP BY 1, 2),
hits AS (SELECT s_suppkey, lat, lon, n, count(*) FILTER ((y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1) % 2 AS inside FROM places, edges GROUP BY 1, 2, 3, 4)
SELECT s_suppkey, sum(n)::BIGINT AS events FROM hits WHERE inside = 1 GROUP BY 1""")
def events_in_areas(spark, sf_dir):
    """Events in the areas of suppliers, which overlap and have holes."""
    y, x, k = F.lit(20.5) + (F.col("s_suppkey") % 23) * 0.05, F.lit(105.1) + (F.col("s_suppkey") % 29) * 0.04, F.lit(0.5) + (F.col("s_suppkey") % 5) * 0.25
    ring = lambda corners: F.array(*(F.struct((y + k * a).alias("lat"), (x + k * b).alias("lon")) for a, b in corners))
    areas = table(spark, sf_dir, "supplier").select("s_suppkey", F.array(*(ring(c) for c in _CORNERS)).alias("rings"))
    return counts_in_polygons(events(spark, sf_dir).select("lat", "lon"), areas, "lat", "lon", ["s_suppkey"], "rings", "events", side=0.5, depth=4)


@query("SELECT event_id, user_id, event_type, date_trunc('hour', ts)::TIMESTAMP AS hour, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) = 1")
def stateful_latest(spark, sf_dir):
    """The latest event of a station, type and hour, kept by a stream's state; each third of the events comes before the stream goes on."""
    folder = shared_folder(spark, "latest")
    use_state_store(spark)
    rows = staged(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), F.date_trunc("hour", "ts").cast("timestamp").alias("hour"), "value"))
    cuts = rows.agg(F.percentile_approx(F.unix_micros("ts"), [1 / 3, 2 / 3])).first()[0]
    third = F.when(F.unix_micros("ts") <= cuts[0], 0).when(F.unix_micros("ts") <= cuts[1], 1).otherwise(2) if cuts else F.lit(0)
    keys = ["user_id", "event_type", "hour"]
    for k in range(3):
        rows.where(third == k).write.mode("append").parquet(f"{folder}/in")
        # Two hours late, and the hour that an event's time may lie behind the start of its own.
        changes = latest_changes(spark.readStream.schema(rows.schema).parquet(f"{folder}/in"), keys, "hour", ["ts", "event_id"], "3 hours")
        upsert_changes(changes, f"{folder}/out", f"{folder}/state", keys).awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("event_id", "user_id", "event_type", F.col("hour").cast("timestamp_ntz").alias("hour"), "value")


#: A plain program: it answers each line with the doubled value and the length of the type.
PROGRAM = "import json, sys\nfor line in sys.stdin:\n    r = json.loads(line)\n    print(json.dumps({'twice': None if r['value'] is None else 2 * r['value'], 'letters': len(r['event_type'] or '')}), flush=True)\n"


@query("SELECT event_id, 2 * value AS twice, length(event_type)::INT AS letters, 'success' AS status, 1 AS attempt FROM events")
def program_answers(spark, sf_dir):
    folder = shared_folder(spark, "programs")
    rows = table(spark, sf_dir, "events").select("event_id", "value", "event_type")
    out = run_programs(rows, f"{folder}/attempts", [sys.executable, "-c", PROGRAM], "twice double, letters int", ["event_id"], timeout_s=30)
    return out.select("event_id", "twice", "letters", "status", "attempt")
