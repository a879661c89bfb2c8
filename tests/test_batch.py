"""The daily batch plan end to end: materialised intermediates and the
curated outputs equal the lazily composed plan."""

import os

from pyspark.sql import functions as F

from vehicle_metrics.plans.fleet import FleetPlan, run_daily_batch

SF = "/root/testdata/sf0.001"


def test_run_daily_batch_writes_outputs(spark, scratch):
    if not os.path.isdir(SF):
        import pytest
        pytest.skip("test data not present")
    plan = FleetPlan.from_testdata(spark, SF)
    paths = run_daily_batch(spark, plan, os.path.join(scratch, "out"))
    assert set(paths) == {"kpi_master", "alerts", "fleet_summary", "driver_ranking", "daily_telemetry"}
    kpi = spark.read.parquet(paths["kpi_master"])
    lazy = FleetPlan.from_testdata(spark, SF).scored
    cols = ["vehicle_id", "risk_score", "weighted_risk_score", "priority_rank", "fuel_efficiency_km_l"]
    assert sorted(map(tuple, kpi.select(cols).collect())) == sorted(map(tuple, lazy.select(cols).collect()))
    alerts = spark.read.parquet(paths["alerts"])
    assert alerts.count() == FleetPlan.from_testdata(spark, SF).alerts.count()
    assert alerts.filter(F.col("alert_date") == "2024-01-31").count() == alerts.count()
    assert any(d.startswith("event_date=") for d in os.listdir(paths["daily_telemetry"]))


def test_batch_job_cli(spark, scratch):
    """spark-submit entry point on small Parquet inputs with the fixed schemas."""
    from fixtures import base_fuel, base_maintenance, base_telemetry

    from vehicle_metrics.plans import batch_job
    from vehicle_metrics.schemas import FUEL_SCHEMA, MAINTENANCE_SCHEMA, TELEMETRY_SCHEMA

    for name, df, schema in (("tele", base_telemetry(spark), TELEMETRY_SCHEMA),
                             ("fuel", base_fuel(spark), FUEL_SCHEMA),
                             ("maint", base_maintenance(spark), MAINTENANCE_SCHEMA)):
        df.select(*[f.name for f in schema.fields]).write.parquet(os.path.join(scratch, name))
    paths = batch_job.main([
        "--telemetry", os.path.join(scratch, "tele"), "--fuel", os.path.join(scratch, "fuel"),
        "--maintenance", os.path.join(scratch, "maint"), "--out", os.path.join(scratch, "out"),
        "--as-of-date", "2024-06-01", "--as-of-ts", "2024-06-03 00:00:00",
        "--reports-out", os.path.join(scratch, "reports"),
    ], spark=spark)
    perf = spark.read.option("header", "true").csv(paths["performance_report"])
    assert "priority_rank" in perf.columns and perf.count() == 2
    assert spark.read.option("header", "true").csv(paths["alert_report"]).count() > 0
    kpi = {r["vehicle_id"]: r for r in spark.read.parquet(paths["kpi_master"]).collect()}
    assert kpi["KA"]["harsh_driving_flag"] == 1 and kpi["KB"]["service_due_soon_flag"] == 1
    alerts = spark.read.parquet(paths["alerts"])
    assert alerts.filter("alert_type = 'SERVICE_DUE_SOON'").count() == 1


def test_batch_outputs_read_materialised_master(spark, scratch):
    """After materialisation, the scored table is planned over the written
    master table, not recomputed from telemetry."""
    import dataclasses

    from vehicle_metrics.storage import materialize

    plan = FleetPlan.from_testdata(spark, SF)
    master = materialize(plan.master, "master_test")
    staged = dataclasses.replace(plan, overrides={"master": master})
    assert staged.master is master
    from vehicle_metrics.operators.alerts import kpi_alerts_one_pass
    files = kpi_alerts_one_pass(staged.master).inputFiles()
    assert files and all("master_test" in f for f in files)
