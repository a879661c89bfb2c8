"""Alerts (L1-L9) and reports."""

from fixtures import D, T, base_fuel, base_maintenance, base_telemetry, maintenance_rows, telemetry_rows

from vehicle_metrics.config import Thresholds
from vehicle_metrics.operators.alerts import (
    build_alert_summary,
    generate_fuel_alerts,
    generate_harsh_driving_alerts,
    generate_high_risk_alerts,
    generate_maintenance_alerts,
    generate_speed_alerts,
    generate_utilisation_alerts,
    kpi_alerts_one_pass,
)
from vehicle_metrics.operators.kpi import build_master_kpi
from vehicle_metrics.operators.reports import (
    build_alert_report,
    build_cost_report,
    build_maintenance_report,
    build_performance_report,
)
from vehicle_metrics.operators.risk import score_vehicle_risk

TS = "2024-06-03 00:00:00"


def _kpi(spark, rows):
    schema = ("vehicle_id string, fuel_efficiency_km_l double, fuel_cost_per_km double, "
              "total_fuel_cost_zar double, fuel_efficiency_flag int")
    return spark.createDataFrame(rows, schema)


def test_fuel_alert_raised_with_vehicle_in_message(spark):
    out = generate_fuel_alerts(_kpi(spark, [("V099", 5.5, 4.5, 1200.0, 1)]), TS).collect()
    assert len(out) == 1
    a = out[0]
    assert a["alert_type"] == "FUEL_EFFICIENCY" and a["severity"] == "MEDIUM"
    assert "V099" in a["alert_message"]
    assert a["alert_message"] == "Vehicle V099 fuel efficiency 5.5 km/L is below the 7.0 km/L threshold."


def test_no_fuel_alert_when_compliant(spark):
    assert generate_fuel_alerts(_kpi(spark, [("V098", 9.0, 2.0, 900.0, 0)]), TS).count() == 0


def _master(spark):
    return build_master_kpi(base_telemetry(spark), base_fuel(spark), base_maintenance(spark))


def test_kpi_alert_texts_and_severities(spark):
    m = _master(spark)
    harsh = generate_harsh_driving_alerts(m, TS).collect()
    assert [(a["vehicle_id"], a["severity"]) for a in harsh] == [("KA", "MEDIUM")]
    assert harsh[0]["alert_message"] == ("Vehicle KA recorded 2.5 harsh events per 100 km — exceeds 1.5 "
                                         "threshold.")
    high = generate_harsh_driving_alerts(m, TS, Thresholds(harsh_severity_high_per_100km=1.9)).first()
    assert high["severity"] == "HIGH"
    maint = {a["alert_type"]: a for a in generate_maintenance_alerts(m, TS).collect()}
    assert maint["MAINTENANCE_COMPLIANCE"]["alert_message"] == (
        "Vehicle KB maintenance compliance at 50.0% — below the 80% threshold.")
    assert maint["SERVICE_DUE_SOON"]["alert_message"] == "Vehicle KB service due in 6 day(s). Schedule immediately."
    # union by name: missing columns are NULL
    assert maint["SERVICE_DUE_SOON"]["compliance_rate"] is None
    util = sorted(a["alert_message"] for a in generate_utilisation_alerts(m, TS).collect())
    assert util[0] == "Vehicle KA utilisation at 6.7% — below the 60% target."
    assert [a["vehicle_id"] for a in generate_high_risk_alerts(m, TS).collect()] == ["KB"]


def test_high_risk_alert(spark):
    kpi = spark.createDataFrame([("V7", 3, "HIGH"), ("V8", 2, "MEDIUM")], "vehicle_id string, risk_score int, risk_tier string")
    a = generate_high_risk_alerts(kpi, TS).collect()
    assert [x["alert_message"] for x in a] == [
        "CRITICAL: Vehicle V7 has breached 3 KPI thresholds simultaneously. Immediate review required."]
    assert a[0]["severity"] == "CRITICAL"


def test_speed_alerts(spark):
    tele = telemetry_rows(spark, [
        dict(event_id="E1", vehicle_id="V1", event_timestamp=T(2024, 6, 1, 8, 30), speed_kmh=130.5),
        dict(event_id="E2", vehicle_id="V1", event_timestamp=T(2024, 6, 1, 9), speed_kmh=120.0),
    ])
    a = generate_speed_alerts(tele, as_of_ts=TS).collect()
    assert [x["alert_message"] for x in a] == ["Speed violation: vehicle V1 recorded 130.5 km/h at 2024-06-01 08:30:00"]


def test_one_pass_equals_per_rule_union(spark):
    m = _master(spark)
    one = sorted((r["vehicle_id"], r["alert_type"], r["severity"], r["alert_message"])
                 for r in kpi_alerts_one_pass(m, TS).collect())
    per = []
    for f in (generate_fuel_alerts, generate_harsh_driving_alerts, generate_maintenance_alerts,
              generate_utilisation_alerts, generate_high_risk_alerts):
        per += [(r["vehicle_id"], r["alert_type"], r["severity"], r["alert_message"]) for r in f(m, TS).collect()]
    assert one == sorted(per)


def test_alert_summary_ids_and_order(spark):
    tele = base_telemetry(spark)
    m = _master(spark)
    a1 = build_alert_summary(m, tele, TS).collect()
    a2 = build_alert_summary(m, tele, TS).collect()
    assert [r["alert_id"] for r in a1] == [r["alert_id"] for r in a2]  # deterministic across recomputation
    assert len({r["alert_id"] for r in a1}) == len(a1)
    order = {"CRITICAL": 0, "HIGH": 1, "MEDIUM": 2}
    levels = [order.get(r["severity"], 3) for r in a1]
    assert levels == sorted(levels)
    assert all(str(r["alert_date"]) == "2024-06-03" for r in a1)
    rep = {(r["alert_type"], r["severity"]): (r["alert_count"], r["vehicles_affected"])
           for r in build_alert_report(build_alert_summary(m, tele, TS)).collect()}
    assert rep[("LOW_UTILISATION", "LOW")] == (2, 2)


def test_null_message_part_gives_null_message(spark):
    kpi = _kpi(spark, [("V1", None, None, None, 1)])
    assert generate_fuel_alerts(kpi, TS).first()["alert_message"] is None


def test_maintenance_report_latest_and_status(spark):
    m = maintenance_rows(spark, [
        dict(record_id="A1", vehicle_id="VA", service_date=D(2024, 5, 1), next_service_date=D(2024, 6, 5),
             cost_zar=10.0, compliant=1),
        dict(record_id="A2", vehicle_id="VA", service_date=D(2024, 5, 1), next_service_date=D(2024, 9, 1),
             cost_zar=20.0, compliant=1),
        dict(record_id="A0", vehicle_id="VA", service_date=D(2024, 4, 1), next_service_date=D(2024, 5, 1),
             cost_zar=30.0, compliant=0),
        dict(record_id="B1", vehicle_id="VB", service_date=D(2024, 3, 1), next_service_date=D(2024, 5, 20),
             cost_zar=40.0, compliant=0),
        dict(record_id="C1", vehicle_id="VC", service_date=D(2024, 3, 1), next_service_date=D(2024, 6, 8),
             cost_zar=50.0, compliant=1),
        dict(record_id="E1", vehicle_id="VE", service_date=D(2024, 3, 1), next_service_date=None,
             cost_zar=60.0, compliant=1),
    ], as_of="2024-06-01")
    rep = build_maintenance_report(m).collect()
    by_v = {r["vehicle_id"]: r for r in rep}
    # equal service_date: record_id descending breaks the tie
    assert by_v["VA"]["last_service_cost_zar"] == 20.0 and by_v["VA"]["compliance_status"] == "ON_TRACK"
    assert by_v["VB"]["compliance_status"] == "OVERDUE"
    assert by_v["VC"]["compliance_status"] == "DUE_SOON"
    assert by_v["VE"]["compliance_status"] == "ON_TRACK"
    # is_overdue ascending: overdue vehicles come last
    assert rep[-1]["vehicle_id"] == "VB"


def test_performance_and_cost_reports(spark):
    scored = score_vehicle_risk(_master(spark))
    perf = build_performance_report(scored).collect()
    assert [r["priority_rank"] for r in perf] == sorted(r["priority_rank"] for r in perf)
    ka = next(r for r in perf if r["vehicle_id"] == "KA")
    assert ka["compliance_pct"] == 80.0 and ka["utilisation_pct"] == 6.7
    cost = build_cost_report(_master(spark)).collect()
    assert [(r["vehicle_id"], r["cost_rank"]) for r in cost] == [("KB", 1), ("KA", 2)]


def test_cost_rank_ties(spark):
    kpi = spark.createDataFrame(
        [("A", 1.0, 1.0, 5.0, 1.0, 1.0), ("B", 1.0, 1.0, 5.0, 1.0, 1.0), ("C", 1.0, 1.0, 9.0, 1.0, 1.0),
         ("D", 1.0, 1.0, None, 1.0, 1.0)],
        "vehicle_id string, total_distance_km double, total_litres double, total_fuel_cost_zar double, "
        "fuel_efficiency_km_l double, fuel_cost_per_km double")
    got = {r["vehicle_id"]: r["cost_rank"] for r in build_cost_report(kpi).collect()}
    assert got == {"C": 1, "A": 2, "B": 2, "D": 4}
