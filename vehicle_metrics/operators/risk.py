"""Weighted vehicle risk (R4), fleet summary (R5) and driver ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vehicle_metrics.config import DEFAULT_THRESHOLDS, DEFAULT_WEIGHTS, RiskWeights, Thresholds
from vehicle_metrics.functions.exprs import flag_sql, per_100km_sql, sql_double, timestamp_sql
from vehicle_metrics.operators.ranking import global_rank, rank_few_values


def add_risk_score(master_kpi_df: DataFrame, weights: RiskWeights = DEFAULT_WEIGHTS) -> DataFrame:
    """weighted_risk_score (0..8) and risk_category."""
    w = weights
    score = (f"(harsh_driving_flag * {int(w.harsh_driving)} + maintenance_flag * {int(w.maintenance)}"
             f" + fuel_efficiency_flag * {int(w.fuel_efficiency)} + utilisation_flag * {int(w.utilisation)})")
    category = (f"CASE WHEN {score} >= {w.critical_min} THEN 'CRITICAL' "
                f"WHEN {score} BETWEEN {w.high_min} AND {w.critical_min - 1} THEN 'HIGH' "
                f"WHEN {score} BETWEEN {w.medium_min} AND {w.high_min - 1} THEN 'MEDIUM' ELSE 'LOW' END")
    return master_kpi_df.selectExpr("*", f"{score} AS weighted_risk_score", f"{category} AS risk_category")


def score_vehicle_risk(master_kpi_df: DataFrame, weights: RiskWeights = DEFAULT_WEIGHTS) -> DataFrame:
    """The risk score and priority_rank (RANK by score descending, gaps
    on ties, NULL scores last). The score is a sum of four weights or NULL, so
    it has at most 17 values."""
    return rank_few_values(add_risk_score(master_kpi_df, weights), "weighted_risk_score", "priority_rank",
                           ascending=False)


def build_fleet_summary(scored_kpi_df: DataFrame, as_of_ts=None,
                        thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """One-row fleet snapshot (a global aggregate: partial sums per
    partition, one tiny final merge)."""
    critical = flag_sql("risk_category = 'CRITICAL'")
    health = (f"round((fleet_avg_fuel_efficiency / {sql_double(thresholds.fuel_efficiency_min_km_l)}"
              " + fleet_avg_compliance_rate + fleet_avg_utilisation_rate) / 3 * 100, 1)")
    return (
        scored_kpi_df
        .agg(*[F.expr(e) for e in [
            "count(vehicle_id) AS total_vehicles",
            "avg(fuel_efficiency_km_l) AS fleet_avg_fuel_efficiency",
            "avg(harsh_events_per_100km) AS fleet_avg_harsh_events_per_100km",
            "avg(compliance_rate) AS fleet_avg_compliance_rate",
            "avg(utilisation_rate) AS fleet_avg_utilisation_rate",
            "CAST(sum(fuel_efficiency_flag) AS BIGINT) AS vehicles_low_fuel_efficiency",
            "CAST(sum(harsh_driving_flag) AS BIGINT) AS vehicles_harsh_driving",
            "CAST(sum(maintenance_flag) AS BIGINT) AS vehicles_maintenance_noncompliant",
            "CAST(sum(utilisation_flag) AS BIGINT) AS vehicles_underutilised",
            f"CAST(sum({critical}) AS BIGINT) AS vehicles_critical_risk",
        ]])
        .selectExpr("*", f"{health} AS fleet_health_score", f"{timestamp_sql(as_of_ts)} AS snapshot_timestamp")
    )


DRIVER_COLUMNS = ["driver_id", "total_distance_km", "total_harsh_events", "avg_speed_kmh",
                  "total_idling_minutes", "harsh_events_per_100km", "driver_safety_rank", "driver_risk_flag"]


def rank_drivers_by_behaviour(telemetry_df: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Per-driver harsh events per 100 km; driver_safety_rank ascending
    (1 = fewest harsh events per 100 km; NULL rates rank first, like Spark's
    ascending order)."""
    stats = (
        telemetry_df
        .where("driver_id IS NOT NULL")
        .groupBy("driver_id")
        .agg(*[F.expr(e) for e in [
            "sum(distance_km) AS total_distance_km",
            "sum(harsh_braking) + sum(harsh_accel) AS total_harsh_events",
            "avg(speed_kmh) AS avg_speed_kmh",
            "sum(idling_minutes) AS total_idling_minutes",
        ]])
        .selectExpr("*", f"{per_100km_sql('total_harsh_events', 'total_distance_km')} AS harsh_events_per_100km")
    )
    ranked = global_rank(stats, "harsh_events_per_100km", "driver_safety_rank", ascending=True)
    risk = flag_sql(f"harsh_events_per_100km > {sql_double(thresholds.harsh_events_per_100km_max)}")
    return ranked.selectExpr(*DRIVER_COLUMNS[:-1], f"{risk} AS driver_risk_flag")
