"""Daily-log generation: vehicle KPIs (G2), alerts (G3) and the dashboard
dataset (G4) over the three daily CSV logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vehicle_metrics.config import DEFAULT_THRESHOLDS, Thresholds
from vehicle_metrics.functions.exprs import flag_sql, ratio_sql, sql_double

DAILY_LOG_KPI_COLUMNS = [
    "vehicle_id", "vehicle_type", "route", "total_km", "active_days", "total_idle_min", "harsh_events",
    "total_litres", "total_fuel_cost", "scheduled_jobs", "completed_jobs", "total_maint_cost",
    "utilisation_pct", "km_per_litre", "fuel_cost_per_km", "harsh_events_per_100km", "idle_ratio",
    "maint_compliance_pct",
]


def daily_log_vehicle_kpis(telematics_df: DataFrame, fuel_df: DataFrame, maintenance_df: DataFrame,
                           thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """One row per (vehicle, type, route) of the telematics log, left
    joined to fuel and maintenance totals (each aggregated once per vehicle,
    so all three sides share the vehicle_id partitioning)."""
    th = thresholds
    tele = telematics_df.groupBy("vehicle_id", "vehicle_type", "route").agg(*[F.expr(e) for e in [
        "sum(km_driven) AS total_km",
        "count(DISTINCT date) AS active_days",
        "sum(idle_minutes) AS total_idle_min",
        "sum(harsh_braking_events) AS harsh_events",
    ]])
    fuel = fuel_df.groupBy("vehicle_id").agg(
        F.expr("sum(litres) AS total_litres"), F.expr("sum(total_cost) AS total_fuel_cost"))
    completed = flag_sql("completed = 'Y'")
    maint = maintenance_df.groupBy("vehicle_id").agg(
        F.expr("count(1) AS scheduled_jobs"),
        F.expr(f"sum({completed}) AS completed_jobs"),
        F.expr("sum(cost) AS total_maint_cost"),
    )
    derived = {
        "utilisation_pct": f"round({ratio_sql('active_days', str(int(th.observation_days)))} * 100, 1)",
        "km_per_litre": f"round({ratio_sql('total_km', 'total_litres')}, 2)",
        "fuel_cost_per_km": f"round({ratio_sql('total_fuel_cost', 'total_km')}, 3)",
        "harsh_events_per_100km": f"round({ratio_sql('harsh_events', 'total_km')} * 100, 2)",
        "idle_ratio": f"round({ratio_sql('total_idle_min', 'active_days * ' + sql_double(th.daily_log_shift_minutes))}, 3)",
        "maint_compliance_pct": f"round({ratio_sql('completed_jobs', 'scheduled_jobs')} * 100, 1)",
    }
    return (
        tele.join(fuel, "vehicle_id", "left").join(maint, "vehicle_id", "left")
        .selectExpr(*[f"{derived[c]} AS {c}" if c in derived else c for c in DAILY_LOG_KPI_COLUMNS])
    )


def daily_log_alerts(vehicle_kpis_df: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """MAINTENANCE_OVERDUE when the completed share is below target."""
    return (
        vehicle_kpis_df
        .where(f"maint_compliance_pct < {sql_double(thresholds.daily_log_compliance_min_pct)}")
        .selectExpr(
            "vehicle_id",
            "'MAINTENANCE_OVERDUE' AS alert",
            "concat('Only ', CAST(maint_compliance_pct AS STRING), '% of scheduled jobs completed') AS detail",
        )
    )


def dashboard_dataset(vehicle_kpis_df: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """The three dashboard series per vehicle with their reference
    lines and the below-target marker on maintenance compliance."""
    th = thresholds
    target = sql_double(th.daily_log_compliance_min_pct)
    return vehicle_kpis_df.selectExpr(
        "vehicle_id",
        "km_per_litre",
        f"{sql_double(th.fuel_efficiency_min_km_l)} AS km_per_litre_threshold",
        "harsh_events_per_100km",
        f"{sql_double(th.harsh_events_per_100km_max)} AS harsh_events_threshold",
        "maint_compliance_pct",
        f"{target} AS compliance_target_pct",
        f"{flag_sql('maint_compliance_pct < ' + target)} AS compliance_below_target",
    )
