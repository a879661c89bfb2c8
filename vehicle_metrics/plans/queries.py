"""Registry of named queries over the benchmark tables.

Each entry takes (spark, sf_dir) and returns a DataFrame computed over the
whole input tables; the comment gives the operator's inventory ID
tests instead. Published doubles are rounded to 6 places (sums of doubles
differ in their last bits with the order rows are added in).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vehicle_metrics.functions.exprs import round_doubles
from vehicle_metrics.operators import alerts, daily_log, kpi, reports
from vehicle_metrics.operators.validation import validate_outputs
from vehicle_metrics.plans import incremental
from vehicle_metrics.plans.fleet import FleetPlan
from vehicle_metrics.schemas import FUEL_SCHEMA, TELEMETRY_SCHEMA
from vehicle_metrics.sources import adapters
from vehicle_metrics.sources.daily_log import read_daily_fuel, read_daily_maintenance, read_daily_telematics
from vehicle_metrics.sources.ingest import clean_fuel, clean_telemetry
from vehicle_metrics.sources.publish import publish, read_published
from vehicle_metrics.sources.quarantine import REASON, RECORD, ingest_checked, mark_rejects, stage_source
from vehicle_metrics.sources.sinks import write_table
from vehicle_metrics.storage import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def _q(build: Callable[[FleetPlan], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(build(FleetPlan.from_testdata(spark, sf_dir)))
    run.__doc__ = build.__doc__
    return run


def _dl_kpis(p: FleetPlan) -> DataFrame:
    return p.daily_log_kpis


def _validate(p: FleetPlan) -> DataFrame:
    return validate_outputs({"kpi_master": p.master, "alerts": p.alerts})


def _round_trip(p: FleetPlan) -> DataFrame:
    table = p.daily_telemetry
    path = f"{shared_folder(table.sparkSession)}/vehicle_metrics/round_trip-{uuid.uuid4().hex}"
    write_table(table, path, partition_by=("event_date",))
    return table.sparkSession.read.parquet(path).select(*table.columns)


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/vehicle_metrics/{name}-{uuid.uuid4().hex}"


def _checked_telemetry(spark: SparkSession, sf_dir: str):
    marked = mark_rejects(adapters.faulty_telemetry(adapters.table(spark, sf_dir, "events")), TELEMETRY_SCHEMA)
    return stage_source(marked, TELEMETRY_SCHEMA)


def checked_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 behind the key check: what is accepted, cleaned."""
    return round_doubles(clean_telemetry(_checked_telemetry(spark, sf_dir).accepted, adapters.BENCH_THRESHOLDS))


def telemetry_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 behind the key check: the rows without a key, with the reason."""
    found = _checked_telemetry(spark, sf_dir).rejects
    return round_doubles(found.select(*TELEMETRY_SCHEMA.fieldNames(), F.col(REASON).alias("reason")))


def telemetry_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 behind the key check: what was counted while the source was read."""
    counts = _checked_telemetry(spark, sf_dir).counts
    return spark.createDataFrame(sorted(counts.items()), "metric string, n long")


def _csv_fuel(spark: SparkSession, sf_dir: str):
    files = adapters.fuel_files(adapters.table(spark, sf_dir, "lineitem"), _scratch(spark, "fuel_csv"))
    return ingest_checked(spark, files, FUEL_SCHEMA, clean_fuel, "csv")


def csv_fuel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fuel fills from headed CSV files, some of whose records cannot be read."""
    return round_doubles(_csv_fuel(spark, sf_dir)[0])


def csv_fuel_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records that could not be read, from their raw text."""
    found = _csv_fuel(spark, sf_dir)[1].rejects
    return found.selectExpr(f"split({RECORD}, ',')[0] AS fuel_id", f"size(split({RECORD}, ',')) AS n_fields",
                            f"split({RECORD}, ',')[2] AS fill_text", f"{REASON} AS reason")


def csv_daily_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: the three daily logs written as headed CSV, read again, and G2 over them."""
    plan, path = FleetPlan.from_testdata(spark, sf_dir), _scratch(spark, "daily_log_csv")
    for name, df in zip(("telematics", "fuel", "maintenance"), plan.daily_log_inputs):
        write_table(df, f"{path}/{name}", "csv")
    logs = (read_daily_telematics(spark, f"{path}/telematics"), read_daily_fuel(spark, f"{path}/fuel"),
            read_daily_maintenance(spark, f"{path}/maintenance"))
    return round_doubles(daily_log.daily_log_vehicle_kpis(*logs, thresholds=plan.thresholds))


def _published(name: str, build: Callable[[FleetPlan], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _scratch(spark, "published")
        publish(spark, {name: build(FleetPlan.from_testdata(spark, sf_dir))}, root)
        return round_doubles(read_published(spark, root, name))
    run.__doc__ = f"K2: {name} staged, published and read through its manifest."
    return run


def incremental_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 built by three runs: the first days, the other days, and late events of both."""
    root = _scratch(spark, "incremental")
    events = adapters.table(spark, sf_dir, "events")
    late, early = "event_id % 10 = 3", "ts < '2024-01-16'"
    for part in (f"NOT ({late}) AND {early}", f"NOT ({late}) AND NOT ({early})", late):
        incremental.advance(adapters.telemetry_from_events(events.where(part)), root, adapters.BENCH_THRESHOLDS)
    return round_doubles(incremental.stored_daily(spark, root))


QUERIES: dict[str, Query] = {
    # sources
    "ingest_telemetry": _q(lambda p: p.telemetry),  # S1
    "ingest_fuel": _q(lambda p: p.fuel),  # S2
    "ingest_maintenance": _q(lambda p: p.maintenance),  # S3
    "validate_join_keys": _q(lambda p: p.coverage_issues),  # S5
    # KPIs
    "fuel_efficiency": _q(lambda p: kpi.compute_fuel_efficiency(p.telemetry, p.fuel, p.thresholds)),  # A1
    "driving_behaviour": _q(lambda p: kpi.compute_driving_behaviour(p.telemetry, p.thresholds)),  # A2
    "maintenance_compliance": _q(lambda p: kpi.compute_maintenance_compliance(p.maintenance, p.thresholds)),  # A3
    "utilisation": _q(lambda p: kpi.compute_utilisation(p.telemetry, thresholds=p.thresholds)),  # A4
    "master_kpi": _q(lambda p: p.master),  # A5
    # time series, risk
    "daily_telemetry": _q(lambda p: p.daily_telemetry),  # R1
    "daily_fuel": _q(lambda p: p.daily_fuel),  # R2
    "rolling_kpis": _q(lambda p: p.rolling),  # R3
    "vehicle_risk": _q(lambda p: p.scored),  # R4
    "fleet_summary": _q(lambda p: p.fleet_summary),  # R5
    "driver_ranking": _q(lambda p: p.drivers),  # R6
    # alerts
    "alerts_fuel": _q(lambda p: alerts.generate_fuel_alerts(p.master, p.as_of_ts, p.thresholds)),  # L1
    "alerts_harsh": _q(lambda p: alerts.generate_harsh_driving_alerts(p.master, p.as_of_ts, p.thresholds)),  # L2
    "alerts_maintenance": _q(lambda p: alerts.generate_maintenance_alerts(p.master, p.as_of_ts, p.thresholds)),  # L3-L5
    "alerts_utilisation": _q(lambda p: alerts.generate_utilisation_alerts(p.master, p.as_of_ts, p.thresholds)),  # L6
    "alerts_high_risk": _q(lambda p: alerts.generate_high_risk_alerts(p.master, p.as_of_ts, p.thresholds)),  # L7
    "alerts_speed": _q(lambda p: alerts.generate_speed_alerts(p.telemetry, None, p.as_of_ts, p.thresholds)),  # L8
    "alert_summary": _q(lambda p: alerts.build_alert_summary(p.master, p.telemetry, p.as_of_ts, p.thresholds)),  # L9
    "alerts_fuel_cost": _q(lambda p: alerts.generate_fuel_cost_alerts(p.master, p.as_of_ts, p.thresholds)),  # X1
    "alerts_idling": _q(lambda p: alerts.generate_idling_alerts(p.daily_telemetry, p.as_of_ts, p.thresholds)),  # X2
    # outputs
    "validate_outputs": _q(_validate),  # X3
    "round_trip_daily_telemetry": _q(_round_trip),  # K1, K2
    # reports
    "report_performance": _q(lambda p: p.report_performance()),  # P1
    "report_weekly_trend": _q(lambda p: p.report_weekly_trend()),  # P2
    "report_maintenance": _q(lambda p: p.report_maintenance()),  # P3
    "report_cost": _q(lambda p: p.report_cost()),  # P4
    "report_alerts": _q(lambda p: p.report_alerts()),  # P5
    "report_weekly_change": _q(lambda p: reports.add_week_over_week(p.report_weekly_trend())),  # P2, week over week
    # checked ingest, files, published outputs, incremental rollup
    "checked_telemetry": checked_telemetry,  # S1
    "telemetry_rejects": telemetry_rejects,  # S1
    "telemetry_counts": telemetry_counts,  # S1
    "csv_fuel": csv_fuel,  # S2, S4
    "csv_fuel_rejects": csv_fuel_rejects,  # S4
    "csv_daily_log": csv_daily_log,  # G1
    "published_kpi_master": _published("kpi_master", lambda p: p.scored),  # K2
    "published_alerts": _published("alerts", lambda p: p.alerts),  # K2
    "published_fleet_summary": _published("fleet_summary", lambda p: p.fleet_summary),  # K2
    "published_driver_ranking": _published("driver_ranking", lambda p: p.drivers),  # K2
    "published_daily_telemetry": _published("daily_telemetry", lambda p: p.daily_telemetry),  # K2
    "incremental_daily": incremental_daily,  # R1
    # daily-log generation
    "daily_log_kpis": _q(_dl_kpis),  # G2 (over G1-shaped views)
    "daily_log_alerts": _q(lambda p: daily_log.daily_log_alerts(p.daily_log_kpis, p.thresholds)),  # G3
    "dashboard_dataset": _q(lambda p: daily_log.dashboard_dataset(p.daily_log_kpis, p.thresholds)),  # G4
}
