"""Report tables (P1-P5). Sorting happens only here, at the output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vehicle_metrics.config import DEFAULT_THRESHOLDS, Thresholds
from vehicle_metrics.functions.exprs import SEVERITY_LEVEL_SQL, per_100km_sql, q
from vehicle_metrics.operators.ranking import global_rank


def build_performance_report(scored_kpi_df: DataFrame, sort: bool = True) -> DataFrame:
    """Renamed KPI columns with percentages, by priority_rank."""
    out = scored_kpi_df.selectExpr(
        "vehicle_id",
        "fuel_efficiency_km_l AS fuel_eff_km_l",
        "fuel_cost_per_km AS fuel_cost_per_km_zar",
        "total_fuel_cost_zar AS total_fuel_spend_zar",
        "harsh_events_per_100km",
        "total_idling_minutes AS total_idling_min",
        "utilisation_rate",
        "compliance_rate",
        "risk_score",
        "risk_category",
        "priority_rank",
        "round(utilisation_rate * 100, 1) AS utilisation_pct",
        "round(compliance_rate * 100, 1) AS compliance_pct",
    )
    return out.orderBy("priority_rank", "vehicle_id") if sort else out


def build_fleet_trend_report(daily_telemetry_df: DataFrame, sort: bool = True) -> DataFrame:
    """Fleet totals per ISO week. ``year`` is the ISO week-numbering
    year, so the days of week 1 that fall in late December are counted with
    the January they belong to."""
    out = (
        daily_telemetry_df
        .groupBy(F.expr("extract(YEAROFWEEK FROM event_date) AS year"), F.expr("weekofyear(event_date) AS iso_week"))
        .agg(*[F.expr(e) for e in [
            "sum(daily_distance_km) AS weekly_distance_km",
            "sum(daily_harsh_events) AS weekly_harsh_events",
            "sum(daily_idling_minutes) AS weekly_idling_minutes",
            "count(DISTINCT vehicle_id) AS active_vehicles",
        ]])
        .selectExpr("*", f"{per_100km_sql('weekly_harsh_events', 'weekly_distance_km')} AS fleet_harsh_per_100km")
    )
    return out.orderBy("year", "iso_week") if sort else out


WEEKLY_CHANGES = {
    "weekly_distance_km": "distance_km_change",
    "weekly_harsh_events": "harsh_events_change",
    "weekly_idling_minutes": "idling_minutes_change",
    "active_vehicles": "active_vehicles_change",
    "fleet_harsh_per_100km": "harsh_per_100km_change",
}


def add_week_over_week(trend_df: DataFrame, sort: bool = True) -> DataFrame:
    """P2 with the change of each measure since the ISO week before, and the
    relative change of the distance in percent; NULL where the week before is
    absent or a value is NULL. The window is over weeks, one row each."""
    monday = "date_add(trunc(make_date(year, 1, 4), 'week'), (iso_week - 1) * 7)"
    week = trend_df.selectExpr("*", f"{monday} AS _monday")
    w = "OVER (ORDER BY _monday)"
    follows = f"datediff(_monday, lag(_monday) {w}) = 7"
    before = {c: f"CASE WHEN {follows} THEN lag({c}) {w} END" for c in WEEKLY_CHANGES}
    out = week.selectExpr(
        *trend_df.columns, *[f"{c} - {before[c]} AS {name}" for c, name in WEEKLY_CHANGES.items()],
        f"round(try_divide(weekly_distance_km - {before['weekly_distance_km']}, {before['weekly_distance_km']}) * 100, 1) "
        "AS distance_change_pct")
    return out.orderBy("year", "iso_week") if sort else out


MAINTENANCE_REPORT_COLUMNS = [
    "vehicle_id", "service_date", "service_type", "next_service_km", "next_service_date",
    "days_until_service", "is_overdue", "compliant",
]


def latest_per_key(df: DataFrame, key: str, order_cols: list[str], keep_cols: list[str]) -> DataFrame:
    """Top-1 row per key by ``order_cols`` descending (NULLs last), as a
    grouped ``max`` over a struct: partial aggregation before the shuffle,
    so a key with millions of rows never lands whole in one task."""
    struct_cols = ", ".join(q(c) for c in [*order_cols, *[c for c in keep_cols if c not in order_cols and c != key]])
    top = df.groupBy(key).agg(F.expr(f"max(struct({struct_cols})) AS _top"))
    return top.selectExpr(*[q(c) if c == key else f"_top.{q(c)} AS {q(c)}" for c in keep_cols])


def build_maintenance_report(maintenance_df: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS,
                             sort: bool = True) -> DataFrame:
    """Latest service per vehicle (service_date, then record_id, both
    descending) with OVERDUE / DUE_SOON / ON_TRACK status; sorted by
    is_overdue then days_until_service, ascending."""
    latest = latest_per_key(
        maintenance_df, "vehicle_id", ["service_date", "record_id"],
        [*MAINTENANCE_REPORT_COLUMNS, "cost_zar"],
    )
    status = (f"CASE WHEN is_overdue = 1 THEN 'OVERDUE' "
              f"WHEN days_until_service <= {int(thresholds.service_due_soon_days)} THEN 'DUE_SOON' "
              f"ELSE 'ON_TRACK' END")
    out = latest.selectExpr(*MAINTENANCE_REPORT_COLUMNS, "cost_zar AS last_service_cost_zar",
                            f"{status} AS compliance_status")
    return out.orderBy("is_overdue", "days_until_service", "vehicle_id") if sort else out


def build_cost_report(kpi_df: DataFrame, sort: bool = True) -> DataFrame:
    """Fuel spend per vehicle with cost_rank (RANK by total spend, desc).
    Spend is compared as published, rounded to 6 places: the last bits of a
    sum of doubles depend on the order of its rows."""
    out = kpi_df.selectExpr(
        "vehicle_id", "total_distance_km", "total_litres", "total_fuel_cost_zar",
        "fuel_efficiency_km_l", "fuel_cost_per_km",
    )
    out = out.selectExpr("*", "round(round(total_fuel_cost_zar, 9), 6) AS _spend")
    out = global_rank(out, "_spend", "cost_rank", ascending=False).drop("_spend")
    return out.orderBy("cost_rank", "vehicle_id") if sort else out


def build_alert_report(alerts_df: DataFrame, sort: bool = True) -> DataFrame:
    """P5: alerts and distinct vehicles per (alert_type, severity)."""
    out = alerts_df.groupBy("alert_type", "severity").agg(
        F.expr("count(alert_id) AS alert_count"),
        F.expr("count(DISTINCT vehicle_id) AS vehicles_affected"),
    )
    return out.orderBy(F.expr(SEVERITY_LEVEL_SQL), "alert_type") if sort else out
