"""Daily rollups (R1, R2) and the trailing-window trend.

The daily telemetry rollup is the one pass over raw events that the
vehicle KPIs, the rolling trend and the weekly report all start from. It
keeps *additive* parts (sums, speed sum and count, max, event count) so
coarser totals can be derived exactly: average speed is sum/count, never an
average of daily averages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vehicle_metrics.config import DEFAULT_THRESHOLDS, Thresholds
from vehicle_metrics.functions.exprs import flag_sql, per_100km_sql, sql_double

DAILY_COLUMNS = [
    "vehicle_id", "event_date", "daily_distance_km", "daily_harsh_braking", "daily_harsh_accel",
    "daily_idling_minutes", "avg_speed_kmh", "max_speed_kmh", "event_count", "daily_harsh_events",
]


DAILY_PARTS_SQL = [
    "sum(distance_km) AS daily_distance_km",
    "sum(harsh_braking) AS daily_harsh_braking",
    "sum(harsh_accel) AS daily_harsh_accel",
    "sum(idling_minutes) AS daily_idling_minutes",
    "sum(speed_kmh) AS speed_sum",
    "count(speed_kmh) AS speed_count",
    "max(speed_kmh) AS max_speed_kmh",
    "count(event_id) AS event_count",
]


def daily_telemetry_parts(telemetry_df: DataFrame) -> DataFrame:
    """(vehicle_id, event_date) -> additive daily aggregates.

    A partial hash aggregate runs before the shuffle, so a vehicle with a
    huge share of events costs one row per map partition and day.
    """
    return telemetry_df.groupBy("vehicle_id", "event_date").agg(*[F.expr(e) for e in DAILY_PARTS_SQL])


def daily_from_parts(parts: DataFrame) -> DataFrame:
    derived = {
        "avg_speed_kmh": "try_divide(speed_sum, speed_count)",
        "daily_harsh_events": "daily_harsh_braking + daily_harsh_accel",
    }
    return parts.selectExpr(*[f"{derived[c]} AS {c}" if c in derived else c for c in DAILY_COLUMNS])


def aggregate_daily_telemetry(telemetry_df: DataFrame) -> DataFrame:
    """One row per vehicle and event_date."""
    return daily_from_parts(daily_telemetry_parts(telemetry_df))


def aggregate_daily_fuel(fuel_df: DataFrame) -> DataFrame:
    """R2: one row per vehicle and fill_date."""
    return fuel_df.groupBy("vehicle_id", "fill_date").agg(
        F.expr("sum(litres_filled) AS daily_litres"),
        F.expr("sum(cost_zar) AS daily_fuel_cost_zar"),
        F.expr("count(fuel_id) AS fill_count"),
    )


def compute_rolling_kpis(daily_telemetry_df: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Trailing N-calendar-day sums per vehicle (N = rolling_window_days).

    The frame is a RANGE over the day number (``unix_date``), so gaps in
    activity shorten the window instead of stretching it. The window input
    is the daily rollup, so one vehicle contributes at most one row per day
    to its partition however many raw events it has.
    """
    days = thresholds.rolling_window_days
    w = (f"OVER (PARTITION BY vehicle_id ORDER BY unix_date(event_date) "
         f"RANGE BETWEEN {days - 1} PRECEDING AND CURRENT ROW)")
    per100 = per_100km_sql("rolling_7d_harsh_events", "rolling_7d_distance_km")
    return (
        daily_telemetry_df
        .selectExpr(
            "*",
            f"sum(daily_distance_km) {w} AS rolling_7d_distance_km",
            f"sum(daily_harsh_events) {w} AS rolling_7d_harsh_events",
            f"sum(daily_idling_minutes) {w} AS rolling_7d_idling_minutes",
        )
        .selectExpr("*", f"{per100} AS rolling_7d_harsh_per_100km")
        .selectExpr("*", flag_sql(f"rolling_7d_harsh_per_100km > {sql_double(thresholds.harsh_events_per_100km_max)}")
                    + " AS behaviour_trend_flag")
    )
