"""Silver: cleaned hourly series of stations, a city, weather, surface fields and satellites."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.config import Settings
from aerolith.functions.units import LOW_LAYER_M, celsius, millimetres, wind_direction, wind_speed
from aerolith.operators.dedup import latest_per_key, newest
from aerolith.operators.quality import bbox_filter, clear_bits, finite, good_pixels, name_or_box, parameter_filter, qa_threshold, quality_filter
from aerolith.operators.spatial import grid_means, idw_gradient
from aerolith.operators.stats import daily_of_files, merged_bands, pixel_stats, series_stats

LAST_WRITTEN = ("ingest_time", "event_id")


def station_hourly(bronze: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One reading per station, sensor and hour: right parameter, good value, inside the box, last written."""
    rows = parameter_filter(bronze.where("event_time is not null"), "parameter", "pm25")
    rows = quality_filter(rows, "value", settings.quality, "coverage_pct")
    rows = bbox_filter(rows, "latitude", "longitude", settings.bbox).withColumn("hour", F.date_trunc("hour", "event_time"))
    return latest_per_key(rows, ["location_id", "sensor_id", "parameter", "hour"], newest(*LAST_WRITTEN)).withColumnRenamed("value", "pm25")


def city_hourly(stations: DataFrame) -> DataFrame:
    return series_stats(stations, ["hour"], "pm25", ["location_id", "sensor_id"], "pm25", "coverage_pct")


def weather_hourly(bronze: DataFrame, pattern: str, settings: Settings = Settings()) -> DataFrame:
    """One weather row per hour of places that are named so or lie in the box."""
    rows = name_or_box(bronze.where("event_time is not null"), ["province", "region", "location_name"], pattern, "lat", "lon", settings.bbox)
    return latest_per_key(rows.withColumn("hour", F.date_trunc("hour", "event_time")), ["hour"], newest(*LAST_WRITTEN))


def gradient_hourly(stations: DataFrame, settings: Settings = Settings()) -> DataFrame:
    out = idw_gradient(stations, "hour", "latitude", "longitude", "pm25", "location_id", "sensor_id", settings.center)
    return out.select("hour", *(F.col(c).alias(f"pm25_{c}") for c in out.columns if c != "hour"))


def surface_hourly(cells: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Hourly means over the box of u10, v10, blh, sp, t2m, d2m, tp, msl, in the units of the gold row."""
    names = ["u10", "v10", "blh", "sp", "t2m", "d2m", "tp", "msl"]
    means = grid_means(cells, ["hour"], "lat", "lon", names, settings.bbox, settings.center)
    u, v = F.col("u10"), F.col("v10")
    return means.select(
        "hour",
        u.alias("wind_u10"),
        v.alias("wind_v10"),
        wind_speed(u, v).alias("wind_speed"),
        wind_direction(u, v).alias("wind_dir"),
        F.col("blh").alias("pbl_height_m"),
        (F.col("blh") < LOW_LAYER_M).alias("low_pbl"),
        F.col("sp").alias("surface_pressure"),
        celsius(F.col("t2m")).alias("temperature_2m_c"),
        celsius(F.col("d2m")).alias("dewpoint_2m_c"),
        millimetres(F.col("tp")).alias("total_precipitation_mm"),
        F.col("msl").alias("mean_sea_level_pressure"),
        "grid_point_count",
    )


def swath_grid(pixels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return good_pixels(pixels, "product", "value", "qa", "lat", "lon", settings.bbox)


def swath_daily(pixels: DataFrame, settings: Settings = Settings(), count_all: bool = False) -> DataFrame:
    """Statistics by product and day of the pixels in the box; `count_all` counts unreadable pixels in the total too."""
    box = bbox_filter(pixels, "lat", "lon", settings.bbox)
    if not count_all:
        box = box.where(finite(F.col("value")))
    least = qa_threshold(F.col("product"))
    return pixel_stats(box, ["product", "date"], "value", finite(F.col("value")) & (F.col("qa") >= least), "source_file", "overpass_time")


def aerosol_daily(pixels: DataFrame, relaxed: bool = False) -> DataFrame:
    """Per day the mean of the files' means: per file both bands and their union, over pixels whose quality word allows use."""
    keys = ["date", "path", "tile"]
    good = clear_bits(F.col("qa"), relaxed)
    band = lambda c: F.when(good, F.col(c))
    rows = pixels.select(*keys, "row", "col", band("aod_047").alias("aod_047"), band("aod_055").alias("aod_055"))
    each = rows.groupBy(*keys).agg(
        F.avg("aod_047").alias("aod_047_mean"), F.avg("aod_055").alias("aod_055_mean"), F.count_if(F.coalesce("aod_047", "aod_055").isNotNull()).alias("valid"), F.count("*").alias("total")
    )
    both = merged_bands(rows, keys, ["aod_047", "aod_055"]).groupBy(*keys).agg(F.avg("value").alias("aod_mean"), F.min("value").alias("aod_min"), F.max("value").alias("aod_max"), F.stddev_pop("value").alias("aod_std"))
    files = each.join(both, keys).where("valid > 0")
    return daily_of_files(files, "date", ["aod_047_mean", "aod_055_mean", "aod_mean"], "aod_min", "aod_max", "aod_std", "valid", "total", "tile", "path")
