"""Physical-plan properties the design relies on (checked on the
benchmark adapters at sf0.001, static broadcasts off so joins keep the
shape a large input gets)."""

import os

import pytest

from vehicle_metrics.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture()
def plan_of(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield lambda name: QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["master_kpi", "alert_summary", "rolling_kpis", "report_weekly_trend",
                                  "daily_log_kpis", "validate_join_keys", "report_maintenance"])
def test_no_single_partition_exchange(plan_of, name):
    assert "SinglePartition" not in plan_of(name)


@pytest.mark.parametrize("name", ["ingest_telemetry", "ingest_fuel", "ingest_maintenance", "master_kpi",
                                  "alerts_fuel", "validate_join_keys"])
def test_building_a_query_starts_no_job(spark, name):
    spark.sparkContext.setJobGroup(f"build {name}", name)
    QUERIES[name](spark, SF)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"build {name}")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(jobs) == []


def test_coverage_check_shuffles_ids_once_above_the_sources(plan_of):
    assert plan_of("validate_join_keys").count("Exchange hashpartitioning(vehicle_id") == 1


def test_fleet_summary_has_no_window(plan_of):
    assert "Window" not in plan_of("fleet_summary")


def test_shuffles_over_rows_follow_partial_aggregates(plan_of):
    plan = plan_of("master_kpi")
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(" in line:
            child = lines[i + 1]
            assert "partial_" in child, child
