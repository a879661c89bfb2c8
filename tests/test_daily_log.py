"""Daily-log generation (G1-G4) on a hand-computed fixture."""

import datetime as dt

from vehicle_metrics.operators.daily_log import dashboard_dataset, daily_log_alerts, daily_log_vehicle_kpis
from vehicle_metrics.schemas import (
    DAILY_LOG_FUEL_SCHEMA,
    DAILY_LOG_MAINTENANCE_SCHEMA,
    DAILY_LOG_TELEMATICS_SCHEMA,
)
from vehicle_metrics.sources.daily_log import read_daily_fuel, read_daily_maintenance, read_daily_telematics
from vehicle_metrics.sources.sinks import write_table

D = dt.date


def _inputs(spark):
    tel = spark.createDataFrame([
        (D(2026, 5, 1), "V1", "Truck", "Cape Town–JHB", 100.0, 80.0, 30.0, 1),
        (D(2026, 5, 2), "V1", "Truck", "Cape Town–JHB", 200.0, 90.0, 60.0, 2),
        (D(2026, 5, 1), "V2", "Van", "JHB–Durban", 50.0, 70.0, 0.0, 0),
    ], DAILY_LOG_TELEMATICS_SCHEMA)
    fuel = spark.createDataFrame([
        (D(2026, 5, 1), "V1", 20.0, 30.0, 600.0),
        (D(2026, 5, 2), "V1", 10.0, 30.0, 300.0),
    ], DAILY_LOG_FUEL_SCHEMA)
    maint = spark.createDataFrame([
        ("V1", D(2026, 5, 6), "Oil change", 100.0, "Y"),
        ("V1", D(2026, 5, 10), "Brake inspection", 200.0, "Y"),
        ("V1", D(2026, 5, 20), "Tyre rotation", 300.0, "N"),
        ("V2", D(2026, 5, 11), "Full service", 50.0, "Y"),
    ], DAILY_LOG_MAINTENANCE_SCHEMA)
    return tel, fuel, maint


def test_vehicle_kpis(spark):
    k = {r["vehicle_id"]: r for r in daily_log_vehicle_kpis(*_inputs(spark)).collect()}
    v1 = k["V1"]
    assert (v1["total_km"], v1["active_days"], v1["total_idle_min"], v1["harsh_events"]) == (300.0, 2, 90.0, 3)
    assert (v1["total_litres"], v1["total_fuel_cost"]) == (30.0, 900.0)
    assert (v1["scheduled_jobs"], v1["completed_jobs"], v1["total_maint_cost"]) == (3, 2, 600.0)
    assert v1["utilisation_pct"] == 6.7 and v1["km_per_litre"] == 10.0 and v1["fuel_cost_per_km"] == 3.0
    assert v1["harsh_events_per_100km"] == 1.0 and v1["idle_ratio"] == 0.075
    assert v1["maint_compliance_pct"] == 66.7
    assert k["V2"]["km_per_litre"] is None and k["V2"]["maint_compliance_pct"] == 100.0


def test_alerts_and_dashboard(spark):
    kpis = daily_log_vehicle_kpis(*_inputs(spark))
    a = [tuple(r) for r in daily_log_alerts(kpis).collect()]
    assert a == [("V1", "MAINTENANCE_OVERDUE", "Only 66.7% of scheduled jobs completed")]
    dash = {r["vehicle_id"]: r for r in dashboard_dataset(kpis).collect()}
    assert dash["V1"]["compliance_below_target"] == 1 and dash["V2"]["compliance_below_target"] == 0
    assert dash["V1"]["km_per_litre_threshold"] == 7.0


def test_csv_round_trip(spark, scratch):
    tel, fuel, maint = _inputs(spark)
    for name, df in (("tel", tel), ("fuel", fuel), ("maint", maint)):
        write_table(df, f"{scratch}/{name}", fmt="csv")
    back = daily_log_vehicle_kpis(read_daily_telematics(spark, f"{scratch}/tel"),
                                  read_daily_fuel(spark, f"{scratch}/fuel"),
                                  read_daily_maintenance(spark, f"{scratch}/maint"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, daily_log_vehicle_kpis(tel, fuel, maint).collect()))
