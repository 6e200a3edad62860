"""Tables by name: schema, keys, partitions; DDL and additive evolution."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from aerolith.plans.gold import MASTER_COLUMNS, TRAINING_COLUMNS

#: Columns that tables share.
DAILY, MONTHLY = ("year", "month", "day"), ("year", "month")
PARTS = "year INT, month INT, day INT"
AUDIT = "source STRING, ingest_time TIMESTAMP, spark_processed_at TIMESTAMP"
SENSOR = "location_id BIGINT, location_name STRING, city STRING, latitude DOUBLE, longitude DOUBLE, provider STRING, sensor_id BIGINT, parameter STRING, unit STRING"


@dataclass(frozen=True)
class Table:
    name: str
    columns: str
    keys: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()

    def schema(self) -> StructType:
        return StructType.fromDDL(self.columns)

    def ddl(self, provider: str = "parquet", location: str | None = None) -> str:
        parts = f" PARTITIONED BY ({', '.join(self.partition_by)})" if self.partition_by else ""
        place = f" LOCATION '{location}'" if location else ""
        return f"CREATE TABLE IF NOT EXISTS {self.name} ({self.columns}) USING {provider}{parts}{place}"


def _t(name: str, columns: str, keys: str = "", partition_by: tuple[str, ...] = ()) -> Table:
    return Table(name, columns, tuple(keys.split()), partition_by)


#: Columns, types, keys and partitions of the tables.
TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        _t(
            "weather_bronze",
            "event_id STRING, province STRING, country STRING, region STRING, location_name STRING, lat DOUBLE, lon DOUBLE, tz_id STRING, query_date DATE, time STRING, time_epoch BIGINT, is_day INT, temp_c DOUBLE, temp_f DOUBLE, "
            "wind_kph DOUBLE, wind_degree INT, wind_dir STRING, pressure_mb DOUBLE, precip_mm DOUBLE, humidity INT, cloud INT, vis_km DOUBLE, uv DOUBLE, will_it_rain INT, chance_of_rain INT, condition_text STRING, condition_code INT, "
            f"event_time TIMESTAMP, {AUDIT}, year INT, month INT",
            "event_id",
            MONTHLY,
        ),
        _t("sensor_bronze", f"event_id STRING, {SENSOR}, datetime_utc STRING, value DOUBLE, min DOUBLE, max DOUBLE, sd DOUBLE, expected_count BIGINT, observed_count BIGINT, coverage_pct DOUBLE, event_time TIMESTAMP, {AUDIT}, {PARTS}, hour INT", "event_id", (*DAILY, "hour")),
        _t(
            "swath_bronze",
            f"event_id STRING, product STRING, content_start STRING, content_end STRING, bbox ARRAY<DOUBLE>, product_name STRING, product_id STRING, file_name STRING, raw_file_path STRING, stats_min DOUBLE, stats_max DOUBLE, stats_mean DOUBLE, stats_valid_pct DOUBLE, event_time TIMESTAMP, {AUDIT}, {PARTS}",
            "event_id",
            ("product", *DAILY),
        ),
        _t("granule_bronze", f"event_id STRING, granule_id STRING, granule_name STRING, short_name STRING, version STRING, tile STRING, acquisition_date STRING, time_start STRING, time_end STRING, download_url STRING, bbox ARRAY<DOUBLE>, event_time TIMESTAMP, {AUDIT}, {PARTS}", "event_id", ("short_name", *DAILY, "tile")),
        _t("reanalysis_files_bronze", f"event_id STRING, dataset_type STRING, year INT, month INT, start_time TIMESTAMP, end_time TIMESTAMP, bbox ARRAY<DOUBLE>, file_path STRING, file_size BIGINT, checksum STRING, {AUDIT}", "event_id", ("dataset_type", *MONTHLY)),
        _t("station_hourly_silver", f"hour TIMESTAMP, {SENSOR}, pm25 DOUBLE, coverage_pct DOUBLE, {AUDIT}, {PARTS}", "location_id sensor_id parameter hour", DAILY),
        _t("city_hourly_silver", f"hour TIMESTAMP, pm25_median DOUBLE, pm25_mean DOUBLE, pm25_min DOUBLE, pm25_max DOUBLE, pm25_std DOUBLE, station_count INT, coverage_avg DOUBLE, {PARTS}, spark_processed_at TIMESTAMP", "hour", DAILY),
        _t("weather_hourly_silver", f"hour TIMESTAMP, vis_km DOUBLE, uv DOUBLE, condition_code INT, is_day INT, will_it_rain INT, chance_of_rain INT, {AUDIT}, {PARTS}", "hour", DAILY),
        _t(
            "surface_hourly_silver",
            f"hour TIMESTAMP, wind_u10 DOUBLE, wind_v10 DOUBLE, wind_speed DOUBLE, wind_dir DOUBLE, pbl_height_m DOUBLE, low_pbl BOOLEAN, surface_pressure DOUBLE, temperature_2m_c DOUBLE, dewpoint_2m_c DOUBLE, total_precipitation_mm DOUBLE, mean_sea_level_pressure DOUBLE, grid_point_count INT, source_file STRING, {PARTS}, spark_processed_at TIMESTAMP",
            "hour",
            DAILY,
        ),
        _t("swath_daily_silver", f"product STRING, date DATE, overpass_time_utc TIMESTAMP, value_mean DOUBLE, value_min DOUBLE, value_max DOUBLE, value_std DOUBLE, valid_pixel_count BIGINT, total_pixel_count BIGINT, valid_pct DOUBLE, unit STRING, source_file STRING, {PARTS}, spark_processed_at TIMESTAMP", "product date", ("product", *DAILY)),
        _t("aerosol_daily_silver", f"date DATE, aod_047_mean DOUBLE, aod_055_mean DOUBLE, aod_mean DOUBLE, aod_min DOUBLE, aod_max DOUBLE, aod_std DOUBLE, valid_pixel_count BIGINT, total_pixel_count BIGINT, valid_pct DOUBLE, tile_count INT, source_files ARRAY<STRING>, {PARTS}, spark_processed_at TIMESTAMP", "date", DAILY),
        _t("master_hourly_gold", ", ".join(f"{c} {t}" for c, t in MASTER_COLUMNS), "hour", ("year", "month_partition")),
        _t("training_gold", ", ".join(f"{c} {t}" for c, t in TRAINING_COLUMNS), "dataset_version feature_set_name hour", ("year", "month_partition")),
        _t("meteo_files_bronze", "source_nc STRING, dataset_type STRING, year INT, month INT, arl_path STRING, start_time TIMESTAMP, end_time TIMESTAMP, status STRING, spark_processed_at TIMESTAMP", "source_nc", ("dataset_type", *MONTHLY)),
        _t("runs_bronze", "run_id STRING, direction STRING, init_time TIMESTAMP, duration_hours INT, init_lat DOUBLE, init_lon DOUBLE, init_alt_m DOUBLE, arl_path STRING, output_path STRING, status STRING, error_message STRING, spark_processed_at TIMESTAMP", "run_id", ("direction",)),
        _t("trajectory_points_silver", "traj_id STRING, direction STRING, traj_no INT, year INT, month INT, day INT, hour INT, minute INT, forecast_hour INT, age_h INT, lat DOUBLE, lon DOUBLE, alt_m DOUBLE, timestamp TIMESTAMP", "traj_id age_h", ("direction", *MONTHLY)),
        _t("trajectory_clusters_silver", "traj_id STRING, cluster_id INT, direction STRING, age_h INT, lat DOUBLE, lon DOUBLE, alt_m DOUBLE, timestamp TIMESTAMP, source_lat DOUBLE, source_lon DOUBLE, source_alt_m DOUBLE", "traj_id age_h", ("direction",)),
        _t("gradient_silver", "hour TIMESTAMP, pm25_grad_n DOUBLE, pm25_grad_s DOUBLE, pm25_grad_e DOUBLE, pm25_grad_w DOUBLE, pm25_spatial_std DOUBLE, pm25_grad_mag DOUBLE, year INT, month INT, spark_processed_at TIMESTAMP", "hour", MONTHLY),
        _t("pixel_grid_silver", f"product STRING, date DATE, lat DOUBLE, lon DOUBLE, value DOUBLE, valid_pct DOUBLE, source_file STRING, {PARTS}, spark_processed_at TIMESTAMP", "product date lat lon source_file", ("product", *MONTHLY)),
        _t("trajectory_paths_silver", "traj_id STRING, path_no2_mean DOUBLE, path_aer_mean DOUBLE, path_no2_max DOUBLE, path_no2_std DOUBLE, path_no2_aer_ratio DOUBLE, spark_processed_at TIMESTAMP", "traj_id"),
        _t("trajectory_hourly_silver", "hour TIMESTAMP, dominant_cluster INT, n_traj INT, source_lat DOUBLE, source_lon DOUBLE, path_no2_mean DOUBLE, path_aer_mean DOUBLE, path_no2_aer_ratio DOUBLE, spark_processed_at TIMESTAMP, year INT, month INT", "hour", MONTHLY),
        _t("model_runs_gold", "model_name STRING, horizon_hours INT, model_path STRING, trained_at TIMESTAMP, validation_mae DOUBLE, validation_rmse DOUBLE, validation_mape DOUBLE, test_mae DOUBLE, test_rmse DOUBLE, test_mape DOUBLE"),
    )
}


def ensure(spark: SparkSession, table: Table, provider: str = "parquet", location: str | None = None) -> list[str]:
    """Create the table, or add the columns it lacks; gives the names of what was added."""
    if not spark.catalog.tableExists(table.name):
        spark.sql(table.ddl(provider, location))
        return []
    have = {c.name for c in spark.catalog.listColumns(table.name)}
    new = [f for f in table.schema().fields if f.name not in have]
    if new:
        spark.sql(f"ALTER TABLE {table.name} ADD COLUMNS ({', '.join(f'{f.name} {f.dataType.simpleString()}' for f in new)})")
    return [f.name for f in new]
