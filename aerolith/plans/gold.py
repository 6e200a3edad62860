"""Gold: one feature row per hour, and the training set with its targets and split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.config import Series
from aerolith.functions.calendar import calendar_columns
from aerolith.functions.text import alias_product
from aerolith.operators.asof import asof_join
from aerolith.operators.joins import left_chain
from aerolith.operators.series import feature_columns, hour_grid, over_hours, time_split
from aerolith.operators.stats import pivot_max

#: The columns of each source that the master row takes, and their types.
AIR = ["pm25_median", "pm25_mean", "station_count", "coverage_avg"]
WEATHER = ["vis_km", "uv", "condition_code", "is_day", "will_it_rain", "chance_of_rain"]
SURFACE = ["wind_u10", "wind_v10", "wind_speed", "wind_dir", "pbl_height_m", "low_pbl", "surface_pressure", "temperature_2m_c", "dewpoint_2m_c", "total_precipitation_mm"]
SWATH = {
    "s5p_no2_mean": ("NO2", "value_mean"),
    "s5p_co_mean": ("CO", "value_mean"),
    "s5p_so2_mean": ("SO2", "value_mean"),
    "s5p_o3_mean": ("O3", "value_mean"),
    "s5p_aer_ai_mean": ("AER_AI", "value_mean"),
    "s5p_no2_valid_pct": ("NO2", "valid_pct"),
    "s5p_aer_ai_valid_pct": ("AER_AI", "valid_pct"),
}
AEROSOL = ["aod_047_mean", "aod_055_mean", "aod_mean", "aod_max"]
GRADIENT = ["pm25_grad_n", "pm25_grad_s", "pm25_grad_e", "pm25_grad_w", "pm25_spatial_std", "pm25_grad_mag"]
TRAJECTORY = {"dominant_cluster": "dominant_cluster", "n_traj": "n_traj", "traj_source_lat": "source_lat", "traj_source_lon": "source_lon", "traj_path_no2_mean": "path_no2_mean", "traj_path_aer_mean": "path_aer_mean", "traj_path_no2_aer_ratio": "path_no2_aer_ratio"}
CALENDAR = ["hour_of_day", "day_of_week", "month", "season", "is_weekend", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos", "is_rush_hour"]
INTEGERS = {"station_count", "condition_code", "is_day", "will_it_rain", "chance_of_rain", "dominant_cluster", "n_traj", "hour_of_day", "day_of_week", "month", "year", "month_partition"}
FEATURE_GROUPS = ["target", "weather", "surface", "satellite", "aerosol", "spatial_gradient", "trajectory", "time", "lag", "rolling"]


def _master_names(series: Series) -> list[str]:
    history = feature_columns("pm25_mean", "pm25", series.lag_hours, series.rolling_hours, series.horizons_hours)
    return ["hour", *AIR, *WEATHER, *SURFACE, *SWATH, *AEROSOL, "aod_valid_pct", *GRADIENT, *TRAJECTORY, *CALENDAR, *history, "year", "month_partition", "spark_processed_at"]


def _kind(name: str) -> str:
    if name in ("hour", "spark_processed_at", "created_at"):
        return "TIMESTAMP"
    if name in INTEGERS:
        return "INT"
    if name in ("low_pbl", "is_weekend", "is_rush_hour"):
        return "BOOLEAN"
    return "STRING" if name in ("season", "dataset_version", "feature_set_name", "split") else "ARRAY<STRING>" if name == "feature_groups" else "DOUBLE"


MASTER_COLUMNS = [(c, _kind(c)) for c in _master_names(Series())]
TRAINING_COLUMNS = [(c, _kind(c)) for c in ["dataset_version", "feature_set_name", "feature_groups", "split", *(c for c, _ in MASTER_COLUMNS if c != "spark_processed_at"), "created_at", "spark_processed_at"]]


def swath_features(hours: DataFrame, swath: DataFrame) -> DataFrame:
    """Per hour the newest usable overpass of each product, as columns."""
    daily = swath.withColumn("product", alias_product(F.col("product")))
    products = sorted({p for p, _ in SWATH.values()})
    probes = hours.select("hour", F.explode(F.array(*(F.lit(p) for p in products))).alias("product"))
    latest = asof_join(probes, daily, "hour", "date", "overpass_time_utc", ["value_mean", "valid_pct"], ["product"])
    return pivot_max(latest, ["hour"], "product", SWATH)


def aerosol_features(hours: DataFrame, aerosol: DataFrame) -> DataFrame:
    """Per hour the newest aerosol day before it."""
    out = asof_join(hours.select("hour"), aerosol, "hour", "date", None, [*AEROSOL, "valid_pct"])
    return out.withColumnRenamed("valid_pct", "aod_valid_pct")


def master(air: DataFrame, weather: DataFrame | None = None, surface: DataFrame | None = None, swath: DataFrame | None = None, aerosol: DataFrame | None = None, gradient: DataFrame | None = None, trajectory: DataFrame | None = None, series: Series = Series()) -> DataFrame:
    """One row per hour from the first to the last of `air`; sources that are absent give nulls."""
    hours = hour_grid(air)
    sides = [air.select("hour", *AIR)]
    sides += [side.select("hour", *columns) for side, columns in ((weather, WEATHER), (surface, SURFACE), (gradient, GRADIENT)) if side is not None]
    if swath is not None:
        sides.append(swath_features(hours, swath))
    if aerosol is not None:
        sides.append(aerosol_features(hours, aerosol))
    if trajectory is not None:
        sides.append(trajectory.select("hour", *(F.col(c).alias(n) for n, c in TRAJECTORY.items())))
    rows = left_chain(hours, sides, ["hour"])
    rows = rows.select("*", *(c.alias(n) for n, c in calendar_columns(F.col("hour")).items()))
    history = feature_columns("pm25_mean", "pm25", series.lag_hours, series.rolling_hours, series.horizons_hours)
    reach = max(*series.lag_hours, *series.rolling_hours, *series.horizons_hours)
    rows = over_hours(rows, "hour", history, reach)
    rows = rows.withColumns({"year": F.year("hour"), "month_partition": F.month("hour"), "spark_processed_at": F.current_timestamp()})
    return rows.select(*((F.col(c) if c in rows.columns else F.lit(None)).cast(_kind(c) if c != "hour" else rows.schema["hour"].dataType).alias(c) for c in _master_names(series)))


def training(gold: DataFrame, version: str, feature_set: str, series: Series = Series()) -> DataFrame:
    """Rows that have every target, with their split in time and the set's names."""
    whole = gold.dropna(subset=[f"pm25_next_{n}h" for n in series.horizons_hours])
    rows = time_split(whole, "hour").withColumns(
        {"dataset_version": F.lit(version), "feature_set_name": F.lit(feature_set), "feature_groups": F.array(*(F.lit(g) for g in FEATURE_GROUPS)), "created_at": F.current_timestamp()}
    )
    return rows.select(*(c for c, _ in TRAINING_COLUMNS))
