"""The whole gold rows from all seven sources, with their SQL: every column of the master row and of the training set."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.plans.gold import MASTER_COLUMNS, TRAINING_COLUMNS, master, training
from aerolith.plans.queries import air_series, events, query, table

PRODUCTS = ["NO2", "CO", "SO2", "O3", "AER"]
#: Hourly sides: event type -> columns as SQL aggregates that both engines read alike.
SIDES = {
    "view": {"vis_km": "max(value)", "uv": "min(value)", "condition_code": "CAST(max(user_id) AS INT)", "is_day": "CAST(min(event_id) % 2 AS INT)", "will_it_rain": "CAST(count(*) % 2 AS INT)", "chance_of_rain": "CAST(count(*) AS INT)"},
    "click": {
        "wind_u10": "avg(value)",
        "wind_v10": "min(value)",
        "wind_speed": "max(value)",
        "wind_dir": "avg(value) + 180",
        "pbl_height_m": "avg(value) * 10",
        "low_pbl": "avg(value) < 30",
        "surface_pressure": "avg(user_id)",
        "temperature_2m_c": "max(value) - min(value)",
        "dewpoint_2m_c": "max(value) - avg(value)",
        "total_precipitation_mm": "avg(value) / 100",
    },
    "signup": {"pm25_grad_n": "avg(value)", "pm25_grad_s": "min(value)", "pm25_grad_e": "max(value)", "pm25_grad_w": "avg(user_id)", "pm25_spatial_std": "max(value) - min(value)", "pm25_grad_mag": "avg(value) * 2"},
    "purchase": {"dominant_cluster": "CAST(count(*) % 6 AS INT)", "n_traj": "CAST(count(DISTINCT user_id) AS INT)", "source_lat": "avg(value) / 10", "source_lon": "avg(user_id) / 10", "path_no2_mean": "min(value)", "path_aer_mean": "max(value)", "path_no2_aer_ratio": "min(value) / max(value)"},
}
AEROSOL = {"aod_047_mean": "avg(value)", "aod_055_mean": "min(value)", "aod_mean": "max(value) / 2", "aod_max": "max(value)", "valid_pct": "avg(user_id)"}


def gold(spark, sf_dir):
    """The master rows: air from errors, an hourly side from each other type of event, satellites by day."""
    rows = events(spark, sf_dir)
    side = lambda kind: rows.where(F.col("event_type") == kind).groupBy("hour").agg(*(F.expr(sql).alias(c) for c, sql in SIDES[kind].items()))
    daily = table(spark, sf_dir, "events").withColumns({"date": F.col("ts").cast("date"), "product": F.element_at(F.array(*map(F.lit, PRODUCTS)), (F.col("event_id") % 5 + 1).cast("int"))})
    swath = daily.groupBy("product", "date").agg(F.min("ts").alias("overpass_time_utc"), F.avg("value").alias("value_mean"), F.avg("event_id").alias("valid_pct"))
    aerosol = daily.groupBy("date").agg(*(F.expr(sql).alias(c) for c, sql in AEROSOL.items()))
    return master(air_series(spark, sf_dir), weather=side("view"), surface=side("click"), swath=swath, aerosol=aerosol, gradient=side("signup"), trajectory=side("purchase"))


def shown(df):
    """Doubles rounded, times of building as whether they are there, lists as text."""
    kinds = dict(df.dtypes)
    show = lambda c: F.round(c, 6) + 0.0 if kinds[c] == "double" else F.col(c).isNotNull() if c in ("spark_processed_at", "created_at") else F.array_join(c, ",") if kinds[c].startswith("array") else F.col(c)
    return df.select(*(show(c).alias(c) for c in df.columns))


HISTORY = {f"pm25_lag_{n}h": f"lag(pm25_mean, {n}) OVER w" for n in (1, 3, 6, 12, 24)} | {f"pm25_roll_mean_{n}h": f"avg(pm25_mean) OVER (ORDER BY hour ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in (3, 6, 24)}
HISTORY |= {"pm25_roll_max_24h": "max(pm25_mean) OVER (ORDER BY hour ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)", "pm25_roll_std_24h": "stddev_samp(pm25_mean) OVER (ORDER BY hour ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)"}
HISTORY |= {f"pm25_next_{n}h": f"lead(pm25_mean, {n}) OVER w" for n in (6, 12, 24)}
CALENDAR = {
    "hour_of_day": "hour(hour)::INT",
    "day_of_week": "(dayofweek(hour) + 1)::INT",
    "month": "month(hour)::INT",
    "season": "CASE WHEN month(hour) IN (12, 1, 2) THEN 'winter' WHEN month(hour) <= 5 THEN 'spring' WHEN month(hour) <= 8 THEN 'summer' ELSE 'autumn' END",
    "is_weekend": "dayofweek(hour) IN (0, 6)",
    "is_rush_hour": "hour(hour) IN (7, 8, 9, 17, 18, 19)",
    "year": "year(hour)::INT",
    "month_partition": "month(hour)::INT",
    "spark_processed_at": "true",
}
CALENDAR |= {f"{n}_{f}": f"{f}(2 * pi() * {x} / {p})" for n, x, p in (("hour", "hour(hour)", 24), ("dow", "(dayofweek(hour) + 1)", 7), ("month", "month(hour)", 12)) for f in ("sin", "cos")}


def _sql() -> str:
    # The master row names the trajectory's columns so.
    named = lambda c: f"traj_{c}" if c.startswith(("source_", "path_")) else c
    sides = [f"{k} AS (SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, {', '.join(f'{sql} AS {named(c)}' for c, sql in columns.items())} FROM events WHERE event_type = '{k}' GROUP BY 1)" for k, columns in SIDES.items()]
    usable = "s.date < grid.hour::DATE OR (s.date = grid.hour::DATE AND s.seen <= grid.hour)"
    swath = [f"s5p_{i} AS (SELECT grid.hour, v AS v{i}, pct AS pct{i} FROM grid LEFT JOIN (SELECT ts::DATE AS date, min(ts) AS seen, avg(value) AS v, avg(event_id) AS pct FROM events WHERE event_id % 5 = {i} GROUP BY 1) s ON {usable} QUALIFY row_number() OVER (PARTITION BY grid.hour ORDER BY s.date DESC NULLS LAST) = 1)" for i in range(5)]
    aerosol = ", ".join(f"{sql} AS {c.replace('valid_pct', 'aod_valid_pct')}" for c, sql in AEROSOL.items())
    names = {"s5p_no2_mean": "v0", "s5p_co_mean": "v1", "s5p_so2_mean": "v2", "s5p_o3_mean": "v3", "s5p_aer_ai_mean": "v4", "s5p_no2_valid_pct": "pct0", "s5p_aer_ai_valid_pct": "pct4"}
    parts = [
        "best AS (SELECT * FROM events WHERE event_type = 'error' QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) = 1)",
        "air AS (SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, quantile_disc(value, 0.5) AS pm25_median, avg(value) AS pm25_mean, count(DISTINCT user_id)::INT AS station_count, 90.0 AS coverage_avg FROM best GROUP BY 1)",
        "grid AS (SELECT unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR))::TIMESTAMP AS hour FROM air)",
        *sides,
        *swath,
        f"aod AS (SELECT grid.hour, a.* EXCLUDE (date) FROM grid LEFT JOIN (SELECT ts::DATE AS date, {aerosol} FROM events GROUP BY 1) a ON a.date < grid.hour::DATE QUALIFY row_number() OVER (PARTITION BY grid.hour ORDER BY a.date DESC NULLS LAST) = 1)",
        f"whole AS (SELECT *, {', '.join(f'{sql} AS {c}' for c, sql in (HISTORY | CALENDAR | names).items())} FROM grid LEFT JOIN air USING (hour) {' '.join(f'LEFT JOIN {k} USING (hour)' for k in SIDES)} {' '.join(f'LEFT JOIN s5p_{i} USING (hour)' for i in range(5))} LEFT JOIN aod USING (hour) WINDOW w AS (ORDER BY hour))",
    ]
    return "WITH " + ",\n".join(parts)


def _shown_sql(columns: list[tuple[str, str]]) -> str:
    return ", ".join(f"round({c}, 6) + 0.0 AS {c}" if kind == "DOUBLE" else c for c, kind in columns)


@query(f"{_sql()} SELECT {_shown_sql(MASTER_COLUMNS)} FROM whole")
def master_rows(spark, sf_dir):
    """All 74 columns of the master row, with all seven sides."""
    return shown(gold(spark, sf_dir)).withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@query(f"""{_sql()}, split AS (SELECT *, 'v1' AS dataset_version, 'all' AS feature_set_name, 'target,weather,surface,satellite,aerosol,spatial_gradient,trajectory,time,lag,rolling' AS feature_groups, true AS created_at,
CASE WHEN share < 0.7 THEN 'train' WHEN share < 0.85 THEN 'validation' ELSE 'test' END AS split FROM (SELECT *, (row_number() OVER (ORDER BY hour) - 1) / count(*) OVER () AS share FROM whole WHERE pm25_next_6h IS NOT NULL AND pm25_next_12h IS NOT NULL AND pm25_next_24h IS NOT NULL))
SELECT {_shown_sql(TRAINING_COLUMNS)} FROM split""")
def training_rows(spark, sf_dir):
    """All columns of the training set."""
    return shown(training(gold(spark, sf_dir), "v1", "all")).withColumn("hour", F.col("hour").cast("timestamp_ntz"))
