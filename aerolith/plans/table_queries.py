"""Registered queries of readers, sinks, table writes and model stages: each goes through files or models that Spark makes of the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from aerolith.checks.checks import compact, schema_hash
from aerolith.config import Runs
from aerolith.functions import first_link, iso_time
from aerolith.ml.cluster import clusters, scaled
from aerolith.ml.forecast import category_stages
from aerolith.operators.joins import covered_runs
from aerolith.operators.quality import good_pixels
from aerolith.operators.series import day_list, month_list
from aerolith.operators.spatial import in_polygon
from aerolith.operators.trajectory import by_init_window, parse_dump
from aerolith.plans.queries import POINTS, events, path_points, query, rounded, table
from aerolith.shared import shared_folder
from aerolith.sinks.serving import collection, csv_export, features, publish
from aerolith.sinks.upsert import append_new, delete_where, empty_table, full_refresh, replace_partitions, upsert
from aerolith.sources.readers import csv_table, dump_lines, file_digests, file_inventory, first_available, json_table, newest_items, resolved_files, serving_table, tile_sums, tolerant, union_groups, weather_files
from aerolith.streaming.pipelines import file_source, flattened, lag_rows, parsed, upsert_to

YEARS = "SELECT o_orderkey AS k, o_custkey AS c, round(o_totalprice, 2) AS v, year(o_orderdate)::INT AS y FROM orders"


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), F.round("o_totalprice", 2).alias("v"), F.year("o_orderdate").alias("y"))


# Writes: a table of orders by year, changed in its files and read again.


@query(f"WITH o AS ({YEARS}), n AS (SELECT k, c, v + 1000 AS v, y FROM o WHERE c % 3 = 0 UNION ALL SELECT -k, c, v, y FROM o WHERE y = 1994) SELECT k, c, round(v, 2) AS v, y FROM n UNION ALL SELECT k, c, v, y FROM o WHERE c % 3 <> 0")
def upserted_files(spark, sf_dir):
    """K3: rows of known keys are replaced, new ones come in, in the partitions that the source touches."""
    path, o = shared_folder(spark, "upsert"), _orders(spark, sf_dir)
    upsert(o, path, ["k", "y"], ["y"])
    new = o.where("c % 3 = 0").withColumn("v", F.round(F.col("v") + 1000, 2)).unionByName(o.where("y = 1994").withColumn("k", -F.col("k")))
    upsert(new, path, ["k", "y"], ["y"])
    return spark.read.parquet(path).select("k", "c", F.round("v", 2).alias("v"), "y")


@query(f"WITH o AS ({YEARS}) SELECT k, c, CASE WHEN y BETWEEN 1994 AND 1995 THEN 0.5 ELSE v END AS v, y FROM o WHERE NOT (y BETWEEN 1994 AND 1995 AND c % 2 = 1)")
def refreshed_range(spark, sf_dir):
    """K5: the rows within the source's range give way to it, also those of keys that it lacks."""
    path, o = shared_folder(spark, "refresh"), _orders(spark, sf_dir)
    replace_partitions(o, path, ["y"])
    full_refresh(o.where("y BETWEEN 1994 AND 1995 AND c % 2 = 0").withColumn("v", F.lit(0.5)), path, "y", ["y"])
    return spark.read.parquet(path).select("k", "c", "v", "y")


@query(f"WITH o AS ({YEARS}) SELECT * FROM o WHERE NOT coalesce(nullif(v, 0) > 100000 AND y <> 1996, false)")
def deleted_rows(spark, sf_dir):
    """K6: a condition's rows go, those for which it is null stay."""
    path, o = shared_folder(spark, "delete"), _orders(spark, sf_dir)
    replace_partitions(o, path, ["y"])
    delete_where(spark, path, (F.nullif(F.col("v"), F.lit(0.0)) > 100000) & (F.col("y") != 1996), ["y"])
    return spark.read.parquet(path).select("k", "c", "v", "y")


@query(f"WITH o AS ({YEARS}) SELECT k, c, v, y FROM o WHERE y NOT IN (1993, 1997) UNION ALL SELECT k, c, -v, y FROM o WHERE y IN (1993, 1997) AND k % 2 = 0")
def overwritten_partitions(spark, sf_dir):
    """K7: the partitions that come replace those of the table, all others stay."""
    path, o = shared_folder(spark, "overwrite"), _orders(spark, sf_dir)
    replace_partitions(o, path, ["y"])
    replace_partitions(o.where("y IN (1993, 1997) AND k % 2 = 0").withColumn("v", -F.col("v")), path, ["y"])
    return spark.read.parquet(path).select("k", "c", "v", "y")


@query(f"WITH o AS ({YEARS}) SELECT k, c, v FROM o WHERE c % 2 = 0 UNION ALL SELECT k, c, -v FROM o WHERE c % 2 = 1")
def appended_new(spark, sf_dir):
    """K8: only rows of new keys are appended."""
    path, o = shared_folder(spark, "append"), _orders(spark, sf_dir).drop("y")
    append_new(o.where("c % 2 = 0"), path, ["k"])
    append_new(o.withColumn("v", -F.col("v")), path, ["k"])
    return spark.read.parquet(path)


@query(f"WITH o AS ({YEARS}) SELECT k, c, v, y, true AS fewer FROM o")
def compacted_files(spark, sf_dir):
    """Q3: a table of many small files in few, with the same rows."""
    path, o = shared_folder(spark, "compact"), _orders(spark, sf_dir)
    o.repartition(16).write.partitionBy("y").parquet(path)
    done = compact(spark, path, ["y"])
    return spark.read.parquet(path).select("k", "c", "v", "y", F.lit(done["files_after"] < done["files_before"]).alias("fewer"))


@query("SELECT user_id, event_type, max(ts) AS ts, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1, 2")
def stream_upsert(spark, sf_dir):
    """K2: batches of a stream merged by key, the latest row of each."""
    folder = shared_folder(spark, "merge")
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    half = rows.agg(F.percentile_approx("ts", 0.5)).first()[0]
    first = F.col("ts") <= F.lit(str(half)).cast(rows.schema["ts"].dataType)
    for part in (first, ~first):
        rows.where(part).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        upsert_to(stream, f"{folder}/out", f"{folder}/state", ["user_id", "event_type"], ["ts", "event_id"]).awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("user_id", "event_type", "ts", "event_id")


# Readers: files made of the tables.


@query("SELECT p_partkey, p_name, p_size, CASE WHEN p_size % 7 = 0 THEN NULL ELSE round(p_retailprice, 2) END AS p_retailprice, NULL::INT AS p_stock FROM part")
def csv_scan(spark, sf_dir):
    """Quoted names, empty and bad fields, and a column that the file lacks; 2.9a: what is missing is a typed null."""
    path = shared_folder(spark, "csv")
    price = F.when(F.col("p_size") % 14 == 0, F.lit("n/a")).when(F.col("p_size") % 7 != 0, F.round("p_retailprice", 2).cast("string"))
    csv_export(table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit('"'), "p_name", F.lit('", x')).alias("p_name"), "p_size", price.alias("p_retailprice")), path)
    rows = csv_table(spark, path, "p_partkey long, p_name string, p_size int, p_retailprice double", escape='"')
    rows = tolerant(rows, {"p_partkey": "long", "p_name": "string", "p_size": "int", "p_retailprice": "double", "p_stock": "int"})
    return rows.withColumn("p_name", F.regexp_replace("p_name", '^"|", x$', ""))


@query("SELECT event_id, user_id, value, props FROM events")
def json_scan(spark, sf_dir):
    path = shared_folder(spark, "json")
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "props")
    rows.write.json(path)
    return json_table(spark, path, rows.schema)


@query("SELECT 'city ' || (user_id % 5) AS province, strftime(ts, '%Y-%m-%d') AS query_date, epoch(date_trunc('minute', ts))::BIGINT AS time_epoch, value AS temp_c, user_id::INT AS humidity, event_type AS condition_text, 'weather_city ' || (user_id % 5) || '_' || epoch(date_trunc('minute', ts))::BIGINT AS event_id FROM events")
def weather_json(spark, sf_dir):
    """A nested day file for each place and day, one row an hour entry."""
    path = shared_folder(spark, "weather")
    epoch = F.unix_seconds(F.date_trunc("minute", "ts").cast("timestamp"))
    hour = F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm").alias("time"), epoch.alias("time_epoch"), F.col("value").alias("temp_c"), F.col("user_id").cast("int").alias("humidity"), F.struct(F.col("event_type").alias("text"), F.lit(1000).alias("code")).alias("condition"))
    rows = table(spark, sf_dir, "events").select(F.expr("concat('city ', user_id % 5)").alias("p"), F.date_format("ts", "yyyy-MM-dd").alias("d"), hour.alias("h"))
    days = rows.groupBy("p", "d").agg(F.collect_list("h").alias("hour"))
    place = F.struct(F.col("p").alias("name"), F.lit(21.0).alias("lat"))
    body = F.to_json(F.struct(place.alias("location"), F.struct(F.array(F.struct(F.col("d").alias("date"), "hour")).alias("forecastday")).alias("forecast")))
    written = days.select(F.concat(F.lit(path + "/"), "p", F.lit("/"), "d", F.lit(".json")).alias("path"), body.alias("text"))
    written.mapInPandas(_write_texts, "path string").count()
    return weather_files(spark, path).select("province", "query_date", "time_epoch", "temp_c", "humidity", "condition_text", "event_id")


def _write_texts(batches):
    """Write each text to its path."""
    import pyarrow.fs as pafs

    for pdf in batches:
        for path, text in zip(pdf["path"], pdf["text"], strict=True):
            store, place = pafs.FileSystem.from_uri(path)
            store.create_dir(place.rpartition("/")[0], recursive=True)
            with store.open_output_stream(place) as out:
                out.write(text.encode())
        yield pdf[["path"]]


@query("SELECT 'run' || (user_id % 4) AS run_id, CASE WHEN user_id % 2 = 0 THEN 'backward' ELSE 'forward' END AS direction, event_id % 9 AS traj_no, (-(event_id % 73))::INT AS age_h, round(20 + (event_id % 97) * 0.02, 3) AS lat, round(105 + (event_id % 89) * 0.02, 3) AS lon, date_trunc('minute', ts)::TIMESTAMP AS timestamp FROM events")
def dump_files(spark, sf_dir):
    """Dump files of four runs, headings among their lines, read in one scan."""
    path = shared_folder(spark, "dumps")
    spot = "cast(20 + (event_id % 97) * 0.02 AS decimal(9,3)), cast(105 + (event_id % 89) * 0.02 AS decimal(9,3)), '500.0'"
    line = f"concat_ws('  ', event_id % 9, 1, date_format(ts, 'yy MM dd HH mm'), 0, concat(-(event_id % 73), '.0'), {spot})"
    rows = table(spark, sf_dir, "events").selectExpr("user_id % 4 AS r", f"explode(array({line}, IF(event_id % 50 = 0, '  3 PRESS THETA', ''))) AS value")
    files = rows.groupBy("r").agg(F.collect_list("value").alias("lines")).select(F.concat(F.lit(path + "/out/tdump_"), "r").alias("path"), F.array_join("lines", "\n").alias("text"))
    files.mapInPandas(_write_texts, "path string").count()
    runs = table(spark, sf_dir, "events").selectExpr("user_id % 4 AS r").distinct().selectExpr("concat('run', r) AS run_id", "IF(r % 2 = 0, 'backward', 'forward') AS direction", "concat('/elsewhere/tdump_', r) AS output_path")
    out = parse_dump(dump_lines(spark, runs, path))
    return out.select("run_id", "direction", F.col("traj_no").cast("long").alias("traj_no"), "age_h", F.round("lat", 3).alias("lat"), F.round("lon", 3).alias("lon"), "timestamp")


GRANULES = "SELECT s_suppkey, 'MCD19A2.A' || (2024000 + 1 + s_suppkey % 300) || '.h' || lpad((20 + s_suppkey % 3)::VARCHAR, 2, '0') || 'v06.061.' || (1000000 + s_suppkey) || '.hdf' AS name, s_name FROM supplier"


def _granules(spark, sf_dir) -> str:
    """A small file a supplier, named as granules are, a third of them of the known format."""
    path = shared_folder(spark, "granules")
    name = "concat('MCD19A2.A', 2024000 + 1 + s_suppkey % 300, '.h', lpad(20 + s_suppkey % 3, 2, '0'), 'v06.061.', 1000000 + s_suppkey, '.hdf')"
    head = "IF(s_suppkey % 3 = 0, concat(char(14), char(3), char(19), char(1)), 'text')"
    table(spark, sf_dir, "supplier").selectExpr(f"concat('{path}/', s_suppkey % 5, '/', {name}) AS path", f"concat({head}, s_name) AS text").mapInPandas(_write_texts, "path string").count()
    return path


@query(f"""WITH g AS ({GRANULES}) SELECT 'MCD19A2' AS short_name, 'h' || lpad((20 + s_suppkey % 3)::VARCHAR, 2, '0') || 'v06' AS tile, count(*) AS files, sum(4 + strlen(s_name))::BIGINT AS bytes,
min(DATE '2024-01-01' + (s_suppkey % 300)::INT)::DATE::VARCHAR AS first_date, max(DATE '2024-01-01' + (s_suppkey % 300)::INT)::DATE::VARCHAR AS last_date, count(*) FILTER (s_suppkey % 3 <> 0) AS unknown FROM g GROUP BY s_suppkey % 3""")
def tile_inventory(spark, sf_dir):
    """Files listed with the format of their first bytes, and summed by tile."""
    sums = tile_sums(file_inventory(spark, _granules(spark, sf_dir)))
    return sums.withColumns({c: F.col(c).cast("string") for c in ("first_date", "last_date")})


@query(f"WITH g AS ({GRANULES}) SELECT s_suppkey, true AS found, sha256(CASE WHEN s_suppkey % 3 = 0 THEN chr(14) || chr(3) || chr(19) || chr(1) ELSE 'text' END || s_name) AS sha256 FROM g")
def resolved_granules(spark, sf_dir):
    """S14, J14, 2.9k: metadata joined with the file that one of its names means, and its digest."""
    path = _granules(spark, sf_dir)
    name = "concat('mcd19a2_a', 2024000 + 1 + s_suppkey % 300, '_H', lpad(20 + s_suppkey % 3, 2, '0'), 'V06_061_', 1000000 + s_suppkey)"
    metadata = table(spark, sf_dir, "supplier").selectExpr("s_suppkey", "concat('s3://old/', s_suppkey, '.nc') AS title", f"{name} AS granule")
    digests = file_digests(spark, path)
    found = resolved_files(metadata, digests.select("path"), ["title", "granule"], ["s_suppkey"])
    return found.join(digests, found["source_path"] == digests["path"], "left").select("s_suppkey", F.col("source_path").isNotNull().alias("found"), "sha256")


@query("SELECT event_type, event_id, ts FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1")
def newest_per_product(spark, sf_dir):
    return newest_items(table(spark, sf_dir, "events").select("event_type", "event_id", "ts"), "event_type", "ts", "event_id")


@query("""WITH u AS (SELECT c_custkey AS k, c_name AS name, c_acctbal AS v, 1 AS g FROM customer UNION ALL SELECT s_suppkey * 2, s_name, NULL, 2 FROM supplier UNION ALL SELECT n_nationkey * 3, n_name, n_regionkey, 3 FROM nation)
SELECT k, name, v::DOUBLE AS v, g FROM u QUALIFY row_number() OVER (PARTITION BY k ORDER BY g DESC) = 1""")
def source_groups(spark, sf_dir):
    """Groups of sources as one, of which one is empty and one is absent."""
    a = table(spark, sf_dir, "customer").selectExpr("CAST(c_custkey AS long) AS k", "c_name AS name", "c_acctbal AS v", "1 AS g")
    b = table(spark, sf_dir, "supplier").selectExpr("CAST(s_suppkey * 2 AS long) AS k", "s_name AS name", "2 AS g")
    c = table(spark, sf_dir, "nation").selectExpr("CAST(n_nationkey * 3 AS long) AS k", "n_name AS name", "CAST(n_regionkey AS double) AS v", "3 AS g")
    return union_groups([a, None, b, empty_table(spark, a.schema), c], ["k"], ["g"]).select("k", "name", "v", "g")


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def serving_scan(spark, sf_dir):
    """S3: a serving table by its connector's name."""
    path = shared_folder(spark, "serving")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    rows.write.orc(path)
    return serving_table(spark, "orc", rows.schema, path=path)


@query("SELECT event_id, user_id, value FROM events")
def published_rows(spark, sf_dir):
    """Rows published as key and JSON value, and what a consumer reads of them."""
    path = shared_folder(spark, "topic")
    publish(table(spark, sf_dir, "events").select("event_id", "user_id", "value"), "parquet", path=path)
    body = F.from_json("value", "event_id long, user_id long, value double").alias("b")
    return spark.read.parquet(path).select("key", body).where(F.col("key") == F.col("b.event_id").cast("string")).select("b.*")


@query("SELECT s_suppkey, round(20 + (s_suppkey % 17) * 0.06, 4) AS lat, s_name FROM supplier")
def geojson_collection(spark, sf_dir):
    """One GeoJSON collection, read back as JSON."""
    path = shared_folder(spark, "geojson")
    rows = table(spark, sf_dir, "supplier").selectExpr("s_suppkey", "s_name", "CAST(20 + (s_suppkey % 17) * 0.06 AS DOUBLE) AS lat", "105.5D AS lon")
    lines = rows.select("s_suppkey").join(features(rows, "lat", "lon", ["s_suppkey", "s_name"]).withColumn("s_suppkey", F.get_json_object("value", "$.properties.s_suppkey").cast("long")), "s_suppkey")
    collection(lines, path, ["s_suppkey"])
    feature = "struct<geometry: struct<coordinates: array<double>>, properties: struct<s_suppkey: long, s_name: string>>"
    # Parts in order of their names are the text of the collection.
    parts = spark.read.text(path, wholetext=True).groupBy(F.regexp_extract("_metadata.file_path", r"([^/]+)$", 1).alias("part")).agg(F.first("value").alias("value"))
    whole = parts.groupBy().agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "value"))), lambda p: p["value"]), "").alias("text"))
    return whole.select(F.explode(F.from_json("text", f"type string, features array<{feature}>")["features"]).alias("f")).select("f.properties.s_suppkey", F.round(F.col("f.geometry.coordinates")[1], 4).alias("lat"), "f.properties.s_name")


# Streams.


@query("SELECT event_id, user_id AS place_id, round(value, 2) AS place_v, epoch_us(ts) AS at_us, hour(ts)::INT AS hour FROM events")
def flattened_json(spark, sf_dir):
    """P3, T6, 2.9d: nested JSON lines of a file stream's kind, flattened, with times of several ISO forms."""
    path = shared_folder(spark, "lines")
    forms = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).when(F.col("event_id") % 3 == 1, F.date_format(F.col("ts") + F.expr("interval 7 hours"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+07:00'")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    body = F.struct("event_id", forms.alias("at"), F.struct(F.col("user_id").alias("id"), F.round("value", 2).alias("v")).alias("place"))
    table(spark, sf_dir, "events").select(F.to_json(body).alias("value")).write.text(f"{path}/in")
    rows = parsed(file_source(spark, f"{path}/in"), "event_id long, at string, place struct<id: long, v: double>", iso_time(F.col("at")))
    rows.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    out = flattened(spark.read.schema(rows.schema).parquet(f"{path}/out"), "place", ["id", "v"])
    return out.select("event_id", "place_id", "place_v", F.unix_micros("event_time").alias("at_us"), "hour")


@query("SELECT event_type AS topic, sum(greatest(0, l - coalesce(c, l)))::BIGINT AS behind, count(c) = 0 OR sum(greatest(0, l - coalesce(c, l))) <= 300 AS ok FROM (SELECT event_type, user_id % 4 AS p, count(*) AS l, CASE WHEN user_id % 4 < 3 THEN count(*) FILTER (value < 60) END AS c FROM events GROUP BY 1, 2) GROUP BY 1")
def consumer_lag(spark, sf_dir):
    """Offsets of topics' partitions against what was committed; one partition has no commit yet."""
    rows = table(spark, sf_dir, "events").withColumns({"topic": F.col("event_type"), "partition": F.col("user_id") % 4})
    latest = rows.groupBy("topic", "partition").agg(F.count("*").alias("offset"))
    done = rows.where("partition < 3").groupBy("topic", "partition").agg(F.count_if(F.col("value") < 60).alias("offset"))
    return lag_rows(latest, done, most=300)


# Columns, lists and geometry.


@query("SELECT o_orderkey, len(generate_series(o_orderdate::DATE, o_orderdate::DATE + (o_custkey % 70)::INT, INTERVAL 1 DAY))::INT AS days, array_to_string(list_transform(generate_series(date_trunc('month', o_orderdate)::TIMESTAMP, (o_orderdate::DATE + (o_custkey % 70)::INT)::TIMESTAMP, INTERVAL 1 MONTH), lambda x: strftime(x, '%Y-%m')), ' ') AS months FROM orders")
def days_and_months(spark, sf_dir):
    """F9."""
    start, end = F.col("o_orderdate").cast("date"), F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_custkey") % 70).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.size(day_list(start, end)).alias("days"), F.array_join(F.transform(month_list(start, end), lambda m: F.date_format(m, "yyyy-MM")), " ").alias("months"))


@query(f"WITH pt AS ({POINTS} FROM events), i AS (SELECT user_id, min(ts) AS init FROM pt WHERE age_h = 0 GROUP BY 1) SELECT event_id, user_id::VARCHAR AS traj_id FROM pt JOIN i USING (user_id) WHERE init >= TIMESTAMP '2024-01-03' AND init < TIMESTAMP '2024-01-10'")
def started_in_window(spark, sf_dir):
    """P5: whole trajectories by the time of their start."""
    return by_init_window(path_points(spark, sf_dir), datetime(2024, 1, 3), datetime(2024, 1, 10)).select("event_id", "traj_id")


@query("""WITH r AS (SELECT event_id, date_trunc('hour', ts) AS i, CASE WHEN event_id % 2 = 0 THEN -72 ELSE 24 END AS d FROM events),
b AS (SELECT *, CASE WHEN d >= 0 THEN i ELSE i + to_hours(d::INT) - INTERVAL 6 HOUR END AS low, CASE WHEN d >= 0 THEN i + to_hours(d::INT) + INTERVAL 6 HOUR ELSE i END AS high FROM r),
f AS (SELECT month(ts) AS m, year(ts) AS y, CASE WHEN max(ts) > TIMESTAMP '2024-01-20' THEN min(ts) END AS a, min(ts) + INTERVAL 20 DAY AS z FROM events GROUP BY 1, 2)
SELECT event_id FROM b JOIN f ON f.m = month(i) AND f.y = year(i) WHERE a IS NULL OR (low >= a AND high <= z)""")
def runs_with_meteo(spark, sf_dir):
    """Runs whose span and one interval more the month's file covers."""
    rows = table(spark, sf_dir, "events")
    runs = rows.select("event_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("init_time"), F.when(F.col("event_id") % 2 == 0, -72).otherwise(24).alias("duration_hours"))
    ts = F.col("ts").cast("timestamp_ntz")
    first = F.when(F.max(ts) > F.lit("2024-01-20").cast("timestamp_ntz"), F.min(ts))
    files = rows.groupBy(F.year("ts").alias("year"), F.month("ts").alias("month")).agg(first.alias("start_time"), (F.min(ts) + F.expr("interval 20 days")).alias("end_time"))
    return covered_runs(runs, files, Runs()).select("event_id")


@query("""WITH p AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'NO2' WHEN 1 THEN 'AER_AI' ELSE 'XX' END AS product, CASE WHEN event_id % 11 = 0 THEN 'nan'::DOUBLE ELSE value END AS value, (user_id % 11) / 10.0 AS qa, 20.4 + (event_id % 97) * 0.012 AS lat, 105.1 + (event_id % 89) * 0.013 AS lon FROM events)
SELECT event_id FROM p WHERE NOT isnan(value) AND lat BETWEEN 20.55 AND 21.40 AND lon BETWEEN 105.25 AND 106.10 AND qa >= CASE product WHEN 'NO2' THEN 0.75 WHEN 'AER_AI' THEN 0.5 ELSE 0.5 END""")
def usable_pixels(spark, sf_dir):
    """P18."""
    rows = table(spark, sf_dir, "events").selectExpr("event_id", "CASE event_id % 3 WHEN 0 THEN 'NO2' WHEN 1 THEN 'AER_AI' ELSE 'XX' END AS product", "IF(event_id % 11 = 0, double('NaN'), value) AS value", "(user_id % 11) / 10.0D AS qa", "20.4D + (event_id % 97) * 0.012D AS lat", "105.1D + (event_id % 89) * 0.013D AS lon")
    return good_pixels(rows, "product", "value", "qa", "lat", "lon").select("event_id")


RING = [(20.6, 105.3), (20.9, 106.2), (21.3, 105.9), (21.1, 105.5), (21.45, 105.2)]


@query(f"""WITH e AS (SELECT unnest([{', '.join(f'[{a}::DOUBLE, {b}::DOUBLE, {c}::DOUBLE, {d}::DOUBLE]' for (a, b), (c, d) in zip(RING, [*RING[1:], RING[0]], strict=True))}]) AS e), p AS (SELECT event_id, (20.55 + (user_id % 17) * 0.06)::DOUBLE AS lat, (105.2 + (user_id % 13) * 0.08)::DOUBLE AS lon FROM events)
SELECT event_id FROM p, e GROUP BY 1 HAVING count(*) FILTER ((e[1] > lat) <> (e[3] > lat) AND lon < (e[4] - e[2]) * (lat - e[1]) / (e[3] - e[1]) + e[2]) % 2 = 1""")
def inside_ring(spark, sf_dir):
    """One literal polygon."""
    return events(spark, sf_dir).where(in_polygon(F.col("lat"), F.col("lon"), RING)).select("event_id")


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 'u' || user_id ELSE 'first' END AS link, value AS measure FROM events")
def nested_links(spark, sf_dir):
    """2.9l, 2.9a: the first own link of an array, and the first of several columns that there is."""
    link = lambda href, inherited: F.struct(href.alias("href"), inherited.alias("inherited"))
    own = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    links = F.when(F.col("event_id") % 4 == 0, F.array(link(own, F.lit(True)))).when(F.col("event_id") % 2 == 0, F.array(link(F.lit("up"), F.lit(True)), link(own, F.lit(None).cast("boolean")))).otherwise(F.array(link(F.lit("first"), F.lit(False)), link(own, F.lit(False))))
    rows = table(spark, sf_dir, "events").select("event_id", "value", first_link(links).alias("link"))
    return first_available(rows, ["val", "value"], "measure").select("event_id", "link", "measure")


@query("SELECT sha256('event_id:bigint;user_id:bigint;value:double') AS schema_hash, count(*) AS rows, max(event_id) AS last FROM events")
def feature_schema_hash(spark, sf_dir):
    """2.9n, Q8: the digest of a feature table's columns beside what it was taken of."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return rows.agg(F.first(schema_hash(rows.dtypes)).alias("schema_hash"), F.count("*").alias("rows"), F.max("event_id").alias("last"))


# Stages of models.


@query("""WITH r AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS a, user_id::DOUBLE AS b FROM events), m AS (SELECT avg(a) AS ma FROM r), f AS (SELECT event_id, coalesce(a, ma) AS a, b FROM r, m)
SELECT event_id, round((a - avg(a) OVER ()) / stddev_samp(a) OVER (), 6) + 0.0 AS a, round((b - avg(b) OVER ()) / stddev_samp(b) OVER (), 6) + 0.0 AS b FROM f""")
def scaled_features(spark, sf_dir):
    """M1, M2: means for what is missing, then standard scores."""
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("a"), F.col("user_id").cast("double").alias("b"))
    return scaled(rows, ["a", "b"]).select("event_id", *((F.round(c, 6) + 0.0).alias(c) for c in ("a", "b")))


@query("SELECT n_nationkey, 0 AS cluster_id FROM nation")
def degenerate_clusters(spark, sf_dir):
    """M4: with one feature that has values, all rows are one cluster."""
    rows = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_regionkey").cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
    return clusters(rows, ["x", "y"]).select("n_nationkey", "cluster_id")


@query("""WITH s AS (SELECT event_id, event_type FROM events), k AS (SELECT event_type, row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS i FROM s GROUP BY 1), n AS (SELECT count(*) AS n FROM k)
SELECT event_id, array_to_string(list_transform(range(n + 1), lambda j: (j = i)::INT), '') AS one_hot FROM s JOIN k USING (event_type), n""")
def one_hot_types(spark, sf_dir):
    """M6: categories by falling frequency as one-hot vectors, whose last place is for unknown ones."""
    from pyspark.ml.functions import vector_to_array

    rows = table(spark, sf_dir, "events").select("event_id", "event_type")
    model = Pipeline(stages=category_stages(["event_type"])).fit(rows)
    return model.transform(rows).select("event_id", F.array_join(F.transform(vector_to_array("__event_type"), lambda x: x.cast("int")), "").alias("one_hot"))
