"""Per-vehicle KPIs (A1-A4) and the master KPI table (A5).

Metric and flag definitions are SQL expression text: each block is added
with one projection, and flags compare the *rounded* metrics, so they are
added in a second projection over the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vehicle_metrics.config import DEFAULT_THRESHOLDS, Thresholds
from vehicle_metrics.functions.exprs import flag_sql, per_100km_sql, ratio_sql, sql_double
from vehicle_metrics.operators.daily import daily_telemetry_parts

# The published columns of the master table, in order.
MASTER_COLUMNS = [
    "vehicle_id",
    "total_distance_km", "total_litres", "total_fuel_cost_zar", "fuel_efficiency_km_l",
    "fuel_cost_per_km", "fuel_efficiency_flag",
    "total_harsh_braking", "total_harsh_accel", "total_idling_minutes", "avg_speed_kmh",
    "total_harsh_events", "harsh_events_per_100km", "harsh_driving_flag",
    "total_services", "compliant_services", "min_days_until_service", "compliance_rate",
    "maintenance_flag", "service_due_soon_flag",
    "active_days", "utilisation_rate", "utilisation_flag",
    "risk_score", "risk_tier",
]


# -- KPI column blocks (shared by the single-KPI operators and the master) ---

def _fuel_metrics() -> list[str]:
    return [
        f"round({ratio_sql('total_distance_km', 'total_litres')}, 2) AS fuel_efficiency_km_l",
        f"round({ratio_sql('total_fuel_cost_zar', 'total_distance_km')}, 4) AS fuel_cost_per_km",
    ]


def _fuel_flags(th: Thresholds) -> list[str]:
    return [flag_sql(f"fuel_efficiency_km_l < {sql_double(th.fuel_efficiency_min_km_l)}")
            + " AS fuel_efficiency_flag"]


def _behaviour_metrics() -> list[str]:
    events = "(total_harsh_braking + total_harsh_accel)"
    return [f"{events} AS total_harsh_events",
            f"{per_100km_sql(events, 'total_distance_km')} AS harsh_events_per_100km"]


def _behaviour_flags(th: Thresholds) -> list[str]:
    return [flag_sql(f"harsh_events_per_100km > {sql_double(th.harsh_events_per_100km_max)}")
            + " AS harsh_driving_flag"]


def _utilisation_metrics(observation_days: int) -> list[str]:
    return [f"round({ratio_sql('active_days', str(int(observation_days)))}, 4) AS utilisation_rate"]


def _utilisation_flags(th: Thresholds) -> list[str]:
    return [flag_sql(f"utilisation_rate < {sql_double(th.utilisation_min_rate)}") + " AS utilisation_flag"]


def _fuel_totals(fuel_df: DataFrame) -> DataFrame:
    return fuel_df.groupBy("vehicle_id").agg(
        F.expr("sum(litres_filled) AS total_litres"),
        F.expr("sum(cost_zar) AS total_fuel_cost_zar"),
    )


# -- A1-A4 --------------------------------------------------------------------

def compute_fuel_efficiency(telemetry_df: DataFrame, fuel_df: DataFrame,
                            thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """A1: km/L and cost/km per vehicle; vehicles need both sources (inner)."""
    distance = telemetry_df.groupBy("vehicle_id").agg(F.expr("sum(distance_km) AS total_distance_km"))
    return (
        distance.join(_fuel_totals(fuel_df), on="vehicle_id", how="inner")
        .selectExpr("*", *_fuel_metrics())
        .selectExpr("*", *_fuel_flags(thresholds))
    )


def compute_driving_behaviour(telemetry_df: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """A2: harsh events per 100 km per vehicle."""
    totals = telemetry_df.groupBy("vehicle_id").agg(*[F.expr(e) for e in [
        "sum(harsh_braking) AS total_harsh_braking",
        "sum(harsh_accel) AS total_harsh_accel",
        "sum(distance_km) AS total_distance_km",
        "sum(idling_minutes) AS total_idling_minutes",
        "avg(speed_kmh) AS avg_speed_kmh",
    ]])
    return totals.selectExpr("*", *_behaviour_metrics()).selectExpr("*", *_behaviour_flags(thresholds))


def compute_maintenance_compliance(maintenance_df: DataFrame,
                                   thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """A3: on-time share of services and the due-soon flag (on the minimum
    days_until_service over a vehicle's records)."""
    th = thresholds
    return (
        maintenance_df
        .groupBy("vehicle_id")
        .agg(
            F.expr("count(record_id) AS total_services"),
            F.expr("sum(compliant) AS compliant_services"),
            F.expr("min(days_until_service) AS min_days_until_service"),
        )
        .selectExpr("*", f"round({ratio_sql('compliant_services', 'total_services')}, 4) AS compliance_rate")
        .selectExpr(
            "*",
            flag_sql(f"compliance_rate < {sql_double(th.maintenance_compliance_min)}") + " AS maintenance_flag",
            flag_sql(f"min_days_until_service BETWEEN 0 AND {int(th.service_due_soon_days)}")
            + " AS service_due_soon_flag",
        )
    )


def compute_utilisation(telemetry_df: DataFrame, observation_days: int | None = None,
                        thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """A4: active days (distinct event dates) over the observation window."""
    days = thresholds.observation_days if observation_days is None else observation_days
    active = telemetry_df.groupBy("vehicle_id").agg(F.expr("count(DISTINCT event_date) AS active_days"))
    return active.selectExpr("*", *_utilisation_metrics(days)).selectExpr("*", *_utilisation_flags(thresholds))


# -- A5 ----------------------------------------------------------------------

VEHICLE_TOTALS_SQL = [
    "sum(daily_distance_km) AS total_distance_km",
    "sum(daily_harsh_braking) AS total_harsh_braking",
    "sum(daily_harsh_accel) AS total_harsh_accel",
    "sum(daily_idling_minutes) AS total_idling_minutes",
    "try_divide(sum(speed_sum), sum(speed_count)) AS avg_speed_kmh",
    "count(event_date) AS active_days",
]


def vehicle_totals_from_daily(daily_parts: DataFrame) -> DataFrame:
    """Vehicle totals from the additive daily rollup (no second pass over
    raw events). active_days counts non-NULL dates, like count(DISTINCT)."""
    return daily_parts.groupBy("vehicle_id").agg(*[F.expr(e) for e in VEHICLE_TOTALS_SQL])


def build_master_kpi(telemetry_df: DataFrame, fuel_df: DataFrame, maintenance_df: DataFrame,
                     observation_days: int | None = None, thresholds: Thresholds = DEFAULT_THRESHOLDS,
                     daily_parts: DataFrame | None = None) -> DataFrame:
    """A5: one row per vehicle with fuel, behaviour, maintenance and
    utilisation KPIs plus risk_score (sum of the four flags) and risk_tier.

    Plan: telemetry is aggregated once (daily rollup -> vehicle totals), fuel
    and maintenance once each; all three outputs are hash-partitioned on
    vehicle_id, so the inner and left joins need no further exchange, and
    AQE may turn either into a broadcast after measuring its real size.
    A vehicle without fuel rows is absent (inner join, as A1); one without
    maintenance rows gets NULL maintenance flags, a NULL risk_score and tier
    NORMAL.
    """
    th = thresholds
    days = th.observation_days if observation_days is None else observation_days
    parts = daily_parts if daily_parts is not None else daily_telemetry_parts(telemetry_df)
    master = (
        vehicle_totals_from_daily(parts)
        .join(_fuel_totals(fuel_df), on="vehicle_id", how="inner")
        .selectExpr("*", *_fuel_metrics(), *_behaviour_metrics(), *_utilisation_metrics(days))
        .selectExpr("*", *_fuel_flags(th), *_behaviour_flags(th), *_utilisation_flags(th))
        .join(compute_maintenance_compliance(maintenance_df, th), on="vehicle_id", how="left")
    )
    score = "(fuel_efficiency_flag + harsh_driving_flag + maintenance_flag + utilisation_flag)"
    tier = (f"CASE WHEN {score} >= {int(th.risk_tier_high)} THEN 'HIGH' "
            f"WHEN {score} = {int(th.risk_tier_medium)} THEN 'MEDIUM' "
            f"WHEN {score} = {int(th.risk_tier_low)} THEN 'LOW' ELSE 'NORMAL' END")
    derived = {"risk_score": score, "risk_tier": tier}
    return master.selectExpr(*[f"{derived[c]} AS {c}" if c in derived else c for c in MASTER_COLUMNS])
