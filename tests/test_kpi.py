"""KPI operators on rows at and beside each limit (see fixtures.py)."""

from fixtures import T, base_fuel, base_maintenance, base_telemetry, by_key, fuel_rows, telemetry_rows

from vehicle_metrics.operators.kpi import (
    build_master_kpi,
    compute_driving_behaviour,
    compute_fuel_efficiency,
    compute_maintenance_compliance,
    compute_utilisation,
)


def test_fuel_efficiency_on_both_sides_of_the_limit(spark):
    r = by_key(compute_fuel_efficiency(base_telemetry(spark), base_fuel(spark)))
    got = {v: (x["fuel_efficiency_km_l"], x["fuel_cost_per_km"], x["fuel_efficiency_flag"]) for v, x in r.items()}
    assert got == {"KA": (10.0, 2.5, 0), "KB": (6.25, 3.5, 1)}


def test_fuel_flag_compares_rounded_value(spark):
    # 6.996 km/L rounds to 7.0, which is not below 7.0.
    tele = telemetry_rows(spark, [dict(event_id="E1", vehicle_id="V1", event_timestamp=T(2024, 6, 1),
                                       speed_kmh=50.0, distance_km=69.96)])
    fuel = fuel_rows(spark, [dict(fuel_id="F1", vehicle_id="V1", fill_timestamp=T(2024, 6, 1),
                                  litres_filled=10.0, cost_zar=1.0)])
    r = by_key(compute_fuel_efficiency(tele, fuel))["V1"]
    assert r["fuel_efficiency_km_l"] == 7.0 and r["fuel_efficiency_flag"] == 0


def test_zero_distance_gives_null_ratios(spark):
    tele = telemetry_rows(spark, [dict(event_id="E1", vehicle_id="V1", event_timestamp=T(2024, 6, 1),
                                       speed_kmh=50.0, distance_km=0.0, harsh_braking=1, harsh_accel=0)])
    fuel = fuel_rows(spark, [dict(fuel_id="F1", vehicle_id="V1", fill_timestamp=T(2024, 6, 1),
                                  litres_filled=10.0, cost_zar=1.0)])
    r = by_key(compute_fuel_efficiency(tele, fuel))["V1"]
    assert r["fuel_cost_per_km"] is None
    b = by_key(compute_driving_behaviour(tele))["V1"]
    assert b["harsh_events_per_100km"] is None and b["harsh_driving_flag"] == 0


def test_driving_behaviour_totals(spark):
    r = by_key(compute_driving_behaviour(base_telemetry(spark)))
    totals = {v: (x["total_harsh_braking"], x["total_harsh_accel"], x["total_harsh_events"]) for v, x in r.items()}
    assert totals == {"KA": (1, 3, 4), "KB": (5, 1, 6)}
    rates = {v: (x["harsh_events_per_100km"], x["harsh_driving_flag"]) for v, x in r.items()}
    assert rates == {"KA": (2.5, 1), "KB": (1.5, 0)}
    assert (r["KA"]["avg_speed_kmh"], r["KB"]["avg_speed_kmh"]) == (70.0, 60.0)


def test_maintenance_compliance(spark):
    r = by_key(compute_maintenance_compliance(base_maintenance(spark)))
    rates = {v: (x["compliance_rate"], x["maintenance_flag"]) for v, x in r.items()}
    assert rates == {"KA": (0.8, 0), "KB": (0.5, 1)}
    due = {v: (x["min_days_until_service"], x["service_due_soon_flag"]) for v, x in r.items()}
    assert due == {"KA": (8, 0), "KB": (6, 1)}


def test_due_soon_uses_minimum_days(spark):
    # An old overdue record (negative days) hides a service due tomorrow.
    from fixtures import D, maintenance_rows

    m = maintenance_rows(spark, [
        dict(record_id="A", vehicle_id="V1", service_date=D(2024, 1, 1), next_service_date=D(2024, 5, 1),
             compliant=1),
        dict(record_id="B", vehicle_id="V1", service_date=D(2024, 5, 20), next_service_date=D(2024, 6, 2),
             compliant=1),
    ])
    r = by_key(compute_maintenance_compliance(m))["V1"]
    assert r["min_days_until_service"] == -31 and r["service_due_soon_flag"] == 0


def test_due_soon_window_edges(spark):
    from fixtures import D, maintenance_rows

    days = {"V0": 0, "V7": 7, "V8": 8, "Vm1": -1}
    m = maintenance_rows(spark, [
        dict(record_id=k, vehicle_id=k, service_date=D(2024, 5, 1),
             next_service_date=D(2024, 6, 1) + __import__("datetime").timedelta(days=v), compliant=1)
        for k, v in days.items()
    ], as_of="2024-06-01")
    r = by_key(compute_maintenance_compliance(m))
    assert {k: r[k]["service_due_soon_flag"] for k in days} == {"V0": 1, "V7": 1, "V8": 0, "Vm1": 0}


def test_utilisation(spark):
    r = by_key(compute_utilisation(base_telemetry(spark)))
    assert {v: x["active_days"] for v, x in r.items()} == {"KA": 2, "KB": 3}
    assert (r["KB"]["utilisation_rate"], r["KB"]["utilisation_flag"]) == (0.1, 1)
    five = by_key(compute_utilisation(base_telemetry(spark), observation_days=5))
    assert {v: (x["utilisation_rate"], x["utilisation_flag"]) for v, x in five.items()} == {"KA": (0.4, 1), "KB": (0.6, 0)}


def test_master_kpi_joins_and_scores(spark):
    tele = base_telemetry(spark)
    fuel = base_fuel(spark)
    maint = base_maintenance(spark)
    m = by_key(build_master_kpi(tele, fuel, maint))
    # KA: harsh and utilisation flagged. KB: fuel, maintenance and utilisation flagged.
    assert {v: (x["risk_score"], x["risk_tier"]) for v, x in m.items()} == {"KA": (2, "MEDIUM"), "KB": (3, "HIGH")}
    assert m["KA"]["avg_speed_kmh"] == 70.0 and m["KA"]["active_days"] == 2


def test_master_matches_single_kpi_operators(spark):
    tele, fuel, maint = base_telemetry(spark), base_fuel(spark), base_maintenance(spark)
    m = by_key(build_master_kpi(tele, fuel, maint))
    a1 = by_key(compute_fuel_efficiency(tele, fuel))
    a2 = by_key(compute_driving_behaviour(tele))
    a4 = by_key(compute_utilisation(tele))
    for v in m:
        assert m[v]["fuel_efficiency_km_l"] == a1[v]["fuel_efficiency_km_l"]
        assert m[v]["harsh_events_per_100km"] == a2[v]["harsh_events_per_100km"]
        assert m[v]["utilisation_rate"] == a4[v]["utilisation_rate"]


def test_vehicle_without_fuel_is_absent_and_without_maintenance_is_normal(spark):
    tele = telemetry_rows(spark, [
        dict(event_id="E1", vehicle_id="VA", event_timestamp=T(2024, 6, 1), speed_kmh=50.0, distance_km=10.0),
        dict(event_id="E2", vehicle_id="VB", event_timestamp=T(2024, 6, 1), speed_kmh=50.0, distance_km=10.0),
    ])
    fuel = fuel_rows(spark, [dict(fuel_id="F1", vehicle_id="VA", fill_timestamp=T(2024, 6, 1),
                                  litres_filled=1.0, cost_zar=1.0)])
    maint = base_maintenance(spark)
    m = by_key(build_master_kpi(tele, fuel, maint))
    assert set(m) == {"VA"}  # VB has no fuel (inner join)
    # VA has no maintenance rows: NULL flag -> NULL score -> NORMAL (D3)
    assert m["VA"]["maintenance_flag"] is None
    assert m["VA"]["risk_score"] is None and m["VA"]["risk_tier"] == "NORMAL"


def test_empty_inputs(spark):
    tele = telemetry_rows(spark, [])
    fuel = fuel_rows(spark, [])
    maint = base_maintenance(spark).limit(0)
    assert build_master_kpi(tele, fuel, maint).count() == 0
