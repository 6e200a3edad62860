"""Batch readers of text, nested JSON, CSV and file inventories."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aerolith.functions.text import normalized_name
from aerolith.functions.times import tile_name_parts
from aerolith.operators.dedup import latest_per_key, newest

#: First bytes of the file formats, and the shape of a day's weather file.
MAGIC = {"hdf5": "894844460D0A1A0A", "hdf4": "0E031301", "netcdf3": "434446"}
WEATHER_HOUR = (
    "time: STRING, time_epoch: LONG, is_day: INT, temp_c: DOUBLE, temp_f: DOUBLE, wind_kph: DOUBLE, wind_degree: INT, wind_dir: STRING, pressure_mb: DOUBLE, precip_mm: DOUBLE, "
    "humidity: INT, cloud: INT, vis_km: DOUBLE, uv: DOUBLE, will_it_rain: INT, chance_of_rain: INT, condition: STRUCT<text: STRING, icon: STRING, code: INT>"
)
WEATHER_DAY = (
    "location STRUCT<name: STRING, region: STRING, country: STRING, lat: DOUBLE, lon: DOUBLE, tz_id: STRING>, "
    f"forecast STRUCT<forecastday: ARRAY<STRUCT<date: STRING, hour: ARRAY<STRUCT<{WEATHER_HOUR}>>>>>"
)


def weather_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per hour of nested day files; the folder names the province, the file the day."""
    days = spark.read.schema(WEATHER_DAY).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    place = F.col("_metadata.file_path")
    days = days.select("location", F.url_decode(F.regexp_extract(place, r"([^/]+)/[^/]+$", 1)).alias("province"), F.regexp_extract(place, r"([^/]+)\.json$", 1).alias("query_date"), F.explode("forecast.forecastday").alias("d"))
    hours = days.select("location", "province", "query_date", F.explode("d.hour").alias("h"))
    out = hours.select("province", "query_date", F.col("location.name").alias("location_name"), *(f"location.{c}" for c in ("region", "country", "lat", "lon", "tz_id")), "h.*")
    out = out.withColumn("condition_text", F.col("condition.text")).withColumn("condition_code", F.col("condition.code")).drop("condition")
    return out.withColumn("event_id", F.concat_ws("_", F.lit("weather"), "province", "time_epoch"))


def dump_lines(spark: SparkSession, runs: DataFrame, path: str) -> DataFrame:
    """Lines of all dump files below `path`, with the run whose output_path they come from; one read, no loop over files."""
    lines = spark.read.option("recursiveFileLookup", True).text(path).select("value", F.col("_metadata.file_path").alias("__path"))
    name = lambda c: F.regexp_extract(c, r"([^/]+)$", 1)
    keyed = runs.select("run_id", "direction", name(F.col("output_path")).alias("__name"))
    return lines.withColumn("__name", name(F.col("__path"))).join(keyed, "__name").select("run_id", "direction", "value")


def csv_table(spark: SparkSession, path: str, schema: StructType | str, escape: str = "\\") -> DataFrame:
    """CSV with a header and a given schema: nothing is inferred, bad fields are null.  `escape` stands before a quote within quotes: a quote itself where they are doubled."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("escape", escape).csv(path)


def json_table(spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def file_inventory(spark: SparkSession, path: str, pattern: str = "*", head: bool = True) -> DataFrame:
    """Path, name, size, time, format by first bytes, and the parts of granule names of all files below `path`.

    Spark lists the files without their content; a task opens each file for its first eight bytes alone (through Arrow's file systems), unless `head` is off.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", "length", "modificationTime")
    name = F.regexp_extract("path", r"([^/]+)$", 1)

    def first_bytes(paths: pd.Series) -> pd.Series:
        out = []
        for p in paths:
            store, place = pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", p))
            with store.open_input_stream(place) as f:
                out.append(f.read(8).hex().upper())
        return pd.Series(out, dtype=str)

    start = F.pandas_udf(first_bytes, "string")("path") if head else F.lit(None).cast("string")
    kind = F.lit("unknown")
    for k, prefix in MAGIC.items():
        kind = F.when(F.col("__start").startswith(prefix), k).otherwise(kind)
    out = files.withColumn("__start", start).select("path", name.alias("name"), F.col("length").alias("bytes"), "modificationTime", kind.alias("format"))
    return out.select("*", *(c.alias(k) for k, c in tile_name_parts(F.col("name")).items()))


def tile_sums(inventory: DataFrame) -> DataFrame:
    """By product and tile of an inventory: files, bytes, first and last day, and files that are of no known format."""
    known = inventory.where(F.col("tile").isNotNull())
    return known.groupBy("short_name", "tile").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.min("acquisition_date").alias("first_date"), F.max("acquisition_date").alias("last_date"), F.count_if(F.col("format") == "unknown").alias("unknown"))


def newest_items(items: DataFrame, product: str, time: str, item: str) -> DataFrame:
    """Of each product the newest item, of equal times that of the greatest id; items without a product or time do not count."""
    return latest_per_key(items.where(F.col(product).isNotNull() & F.col(time).isNotNull()), [product], newest(time, item))


def union_groups(groups: Sequence[DataFrame | None], key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of all groups of sources that are there, by name; missing columns are null, and of rows with equal keys the newest in `order` stays."""
    there = [g for g in groups if g is not None]
    if not there:
        raise ValueError("no group of sources is there")
    whole = there[0]
    for g in there[1:]:
        whole = whole.unionByName(g, allowMissingColumns=True)
    return latest_per_key(whole, list(key), newest(*order))


def serving_table(spark: SparkSession, kind: str, schema: StructType | str | None = None, **options: str) -> DataFrame:
    """A table of a serving store by its connector's format name, with the schema given, if it is, so that nothing is inferred."""
    reader = spark.read.format(kind).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load()


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def resolved_files(metadata: DataFrame, files: DataFrame, names: Sequence[str], key: Sequence[str]) -> DataFrame:
    """`metadata` with the file that one of its name columns names, whatever case, folder and extension; the first name wins."""
    stem = lambda c: normalized_name(F.regexp_replace(F.regexp_extract(c, r"([^/]+)$", 1), r"\.(nc|nc4|hdf|h5|he5|zip)$", ""))
    asked = metadata.select(*key, F.posexplode(F.array(*(stem(F.col(n)) for n in names))).alias("__rank", "__stem")).where(F.col("__stem") != "")
    listed = files.select(F.col("path").alias("source_path"), stem(F.col("path")).alias("__stem"))
    best = asked.join(listed, "__stem").groupBy(*key).agg(F.min_by("source_path", F.struct("__rank", "source_path")).alias("source_path"))
    return metadata.join(best, list(key), "left")


def tolerant(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """The named columns with their types; missing ones are typed nulls."""
    return df.select(*((F.col(c).try_cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in columns.items()))


def first_available(df: DataFrame, names: Sequence[str], out: str) -> DataFrame:
    """Add the first of these columns that the table has, or null."""
    found = next((n for n in names if n in df.columns), None)
    return df.withColumn(out, F.col(found) if found else F.lit(None).cast("double"))
