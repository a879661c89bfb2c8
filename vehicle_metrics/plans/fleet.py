"""Composed plans over the fleet sources.

``FleetPlan`` wires the operators the way the daily batch runs them:
cleaned sources -> one daily rollup -> master KPI -> scored KPI -> alerts
and reports. Every attribute is a lazy DataFrame; nothing runs until an
action. ``run_daily_batch`` materialises the shared intermediates once to
the cluster's checkpoint folder (cutting lineage, so a lost executor only
recomputes from the written table) and writes the curated outputs.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vehicle_metrics.config import DEFAULT_THRESHOLDS, DEFAULT_WEIGHTS, RiskWeights, Thresholds
from vehicle_metrics.functions.exprs import date_sql
from vehicle_metrics.operators import alerts, daily, daily_log, kpi, reports, risk
from vehicle_metrics.operators.validation import OUTPUT_KEYS, validate_outputs
from vehicle_metrics.sources import adapters
from vehicle_metrics.sources.ingest import clean_fuel, clean_maintenance, clean_telemetry, validate_join_keys
from vehicle_metrics.sources.publish import publish, published_paths, read_published
from vehicle_metrics.sources.sinks import write_reports
from vehicle_metrics.storage import drop_materialized, materialize, written_so_far


def _resolve(x):
    """Inputs may be DataFrames or zero-argument callables returning one, so
    a plan only opens the sources its outputs need."""
    return x() if callable(x) else x


@dataclass
class FleetPlan:
    raw_telemetry: object
    raw_fuel: object
    raw_maintenance: object
    as_of_date: object = None
    as_of_ts: object = None
    thresholds: Thresholds = DEFAULT_THRESHOLDS
    weights: RiskWeights = DEFAULT_WEIGHTS
    customer: object = None
    nation: object = None
    unique_telemetry: bool = False  # event_id is known not to repeat, so nothing is regrouped
    unique_fuel: bool = False  # the same for fuel_id
    overrides: dict = field(default_factory=dict)

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str) -> FleetPlan:
        def t(name):
            return lambda: adapters.table(spark, sf_dir, name)

        return cls(
            lambda: adapters.telemetry_from_events(t("events")()),
            lambda: adapters.fuel_from_lineitem(t("lineitem")()),
            lambda: adapters.maintenance_from_orders(t("orders")()),
            as_of_date=adapters.AS_OF_DATE, as_of_ts=adapters.AS_OF_TS,
            thresholds=adapters.BENCH_THRESHOLDS, customer=t("customer"), nation=t("nation"))

    def _get(self, name: str, build):
        return self.overrides[name] if name in self.overrides else build()

    # sources
    @cached_property
    def telemetry(self) -> DataFrame:
        return self._get("telemetry", lambda: clean_telemetry(
            _resolve(self.raw_telemetry), self.thresholds, self.unique_telemetry))

    @cached_property
    def fuel(self) -> DataFrame:
        return self._get("fuel", lambda: clean_fuel(_resolve(self.raw_fuel), self.unique_fuel))

    @cached_property
    def maintenance(self) -> DataFrame:
        return self._get("maintenance", lambda: clean_maintenance(_resolve(self.raw_maintenance), self.as_of_date))

    @cached_property
    def coverage_issues(self) -> DataFrame:
        return validate_join_keys(self.telemetry, self.fuel, self.maintenance)

    # time series
    @cached_property
    def daily_parts(self) -> DataFrame:
        return self._get("daily_parts", lambda: daily.daily_telemetry_parts(self.telemetry))

    @cached_property
    def daily_telemetry(self) -> DataFrame:
        return daily.daily_from_parts(self.daily_parts)

    @cached_property
    def daily_fuel(self) -> DataFrame:
        return daily.aggregate_daily_fuel(self.fuel)

    @cached_property
    def rolling(self) -> DataFrame:
        return daily.compute_rolling_kpis(self.daily_telemetry, self.thresholds)

    # KPIs and risk
    @cached_property
    def master(self) -> DataFrame:
        return self._get("master", lambda: kpi.build_master_kpi(
            self.telemetry, self.fuel, self.maintenance, thresholds=self.thresholds,
            daily_parts=self.daily_parts))

    @cached_property
    def scored(self) -> DataFrame:
        return risk.score_vehicle_risk(self.master, self.weights)

    @cached_property
    def fleet_summary(self) -> DataFrame:
        return risk.build_fleet_summary(risk.add_risk_score(self.master, self.weights), self.as_of_ts, self.thresholds)

    @cached_property
    def drivers(self) -> DataFrame:
        return risk.rank_drivers_by_behaviour(self.telemetry, self.thresholds)

    # alerts and reports
    @cached_property
    def alerts(self) -> DataFrame:
        return alerts.build_alert_summary(self.master, self.telemetry, self.as_of_ts, self.thresholds,
                                          sort=False)

    def report_performance(self) -> DataFrame:
        return reports.build_performance_report(self.scored)

    def report_weekly_trend(self) -> DataFrame:
        return reports.build_fleet_trend_report(self.daily_telemetry)

    def report_maintenance(self) -> DataFrame:
        return reports.build_maintenance_report(self.maintenance, self.thresholds)

    def report_cost(self) -> DataFrame:
        return reports.build_cost_report(self.master)

    def report_alerts(self) -> DataFrame:
        return reports.build_alert_report(self.alerts)

    # daily-log generation over views shaped like its CSV files
    @cached_property
    def daily_log_inputs(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return adapters.daily_log_views(self.daily_telemetry, self.daily_fuel, self.maintenance,
                                        _resolve(self.customer), _resolve(self.nation))

    @cached_property
    def daily_log_kpis(self) -> DataFrame:
        return daily_log.daily_log_vehicle_kpis(*self.daily_log_inputs, thresholds=self.thresholds)


def _check(staged: Mapping[str, DataFrame]) -> DataFrame:
    """X3 over the tables that a run has staged: keys are unique and not NULL,
    and there are vehicles. Alerts and drivers may be none."""
    found = validate_outputs({n: staged[n] for n in OUTPUT_KEYS if n in staged})
    return found.withColumn("passed", F.expr(
        "null_keys = 0 AND repeated_keys = 0 AND (row_count > 0 OR table_name <> 'kpi_master')"))


def run_daily_batch(spark: SparkSession, plan: FleetPlan, output_root: str, fmt: str = "parquet",
                    reports_root: str | None = None) -> dict[str, str]:
    """Entry point A + B: materialise the cleaned telemetry and the daily
    rollup once, then derive the curated outputs from them, write them aside,
    validate what was written (X3) and publish the set; a table that fails
    raises an error and leaves the old set in place (read it with
    ``sources.publish.read_published``). The alerts of the as-of date are
    replaced even if there are none now. With ``reports_root``, the P1-P5
    reports are written as CSV too. The as-of date and time are fixed once, at
    the start, and the intermediate tables are deleted at the end, also after
    a failure."""
    now = datetime.now()
    plan = dataclasses.replace(plan, as_of_ts=plan.as_of_ts or now.strftime("%Y-%m-%d %H:%M:%S"),
                               as_of_date=plan.as_of_date or now.date())
    mark = written_so_far(spark)
    try:
        telemetry = materialize(plan.telemetry, "telemetry")
        parts = materialize(daily.daily_telemetry_parts(telemetry), "daily_parts")
        overrides = {"telemetry": telemetry, "daily_parts": parts, **plan.overrides}
        master = materialize(dataclasses.replace(plan, overrides=dict(overrides)).master, "master")
        staged = dataclasses.replace(plan, overrides={**overrides, "master": master})
        tables = {
            "kpi_master": staged.scored,
            "alerts": staged.alerts,
            "fleet_summary": staged.fleet_summary,
            "driver_ranking": staged.drivers,
            "daily_telemetry": staged.daily_telemetry,
        }
        published = publish(spark, tables, output_root, fmt, replace={"alerts": [str(plan.as_of_ts)[:10]]}, check=_check)
        paths = published_paths(output_root, published)
        if reports_root:
            today = f"alert_date = {date_sql(str(plan.as_of_ts)[:10])}"
            reports_out = {
                "performance_report": staged.report_performance(),
                "weekly_trend_report": staged.report_weekly_trend(),
                "maintenance_report": staged.report_maintenance(),
                "cost_report": staged.report_cost(),
                "alert_report": reports.build_alert_report(read_published(spark, output_root, "alerts").where(today)),
            }
            paths.update(write_reports(reports_out, reports_root))
        return paths
    finally:
        drop_materialized(spark, mark)
