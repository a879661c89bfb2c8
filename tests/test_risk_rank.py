"""Weighted risk (R4), fleet summary (R5), driver ranking (R6) and the
scalable global rank (equivalence with the single-partition RANK())."""

import random

import pytest
from fixtures import T, base_fuel, base_maintenance, base_telemetry, by_key, plain_rank, telemetry_rows

from vehicle_metrics.operators.kpi import build_master_kpi
from vehicle_metrics.operators.ranking import global_rank
from vehicle_metrics.operators.risk import build_fleet_summary, rank_drivers_by_behaviour, score_vehicle_risk


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("per_bucket", [3, 50, 1_000_000])
def test_global_rank_equals_plain_rank(spark, ascending, per_bucket):
    rnd = random.Random(7)
    vals = [rnd.choice([None, 0.0, 0.0, 0.0, 1.5, 2.25]) if i % 3 else rnd.randint(0, 40) / 4
            for i in range(400)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, x double")
    got = global_rank(df, "x", "r", ascending=ascending, values_per_bucket=per_bucket)
    exp = plain_rank(df, "x", "r", ascending=ascending)
    assert _rows(got, ["id", "x", "r"]) == _rows(exp, ["id", "x", "r"])


def test_global_rank_with_a_value_held_by_half_the_rows(spark):
    df = spark.range(0, 6000).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 0.0D WHEN id % 11 = 0 THEN NULL "
                                               "ELSE CAST(id AS DOUBLE) END AS x")
    got, exp = global_rank(df, "x", "r", values_per_bucket=100), plain_rank(df, "x", "r")
    assert _rows(got.selectExpr("id", "r"), ["id", "r"]) == _rows(exp, ["id", "r"])


def test_global_rank_bounded_domain_with_nulls(spark):
    df = spark.createDataFrame([(i, None if i % 11 == 0 else i % 9) for i in range(200)], "id int, s int")
    got = global_rank(df, "s", "r", ascending=False)
    exp = plain_rank(df, "s", "r", ascending=False)
    assert _rows(got, ["id", "s", "r"]) == _rows(exp, ["id", "s", "r"])


def _scored(spark):
    return score_vehicle_risk(build_master_kpi(base_telemetry(spark), base_fuel(spark), base_maintenance(spark)))


def test_score_vehicle_risk(spark):
    r = by_key(_scored(spark))
    # KA: harsh 3 + utilisation 1; KB: maintenance 2 + fuel 2 + utilisation 1
    got = {v: (x["weighted_risk_score"], x["risk_category"], x["priority_rank"]) for v, x in r.items()}
    assert got == {"KA": (4, "HIGH", 2), "KB": (5, "HIGH", 1)}


def test_null_weighted_score_is_low_and_last(spark):
    tele = telemetry_rows(spark, [
        dict(event_id="E1", vehicle_id="VA", event_timestamp=T(2024, 6, 1), speed_kmh=1.0, distance_km=1.0),
        dict(event_id="E2", vehicle_id="KA", event_timestamp=T(2024, 6, 1), speed_kmh=1.0, distance_km=1.0,
             harsh_braking=5, harsh_accel=0),
    ])
    from fixtures import fuel_rows
    fuel = fuel_rows(spark, [dict(fuel_id=f"F{v}", vehicle_id=v, fill_timestamp=T(2024, 6, 1),
                                  litres_filled=1.0, cost_zar=1.0) for v in ["VA", "KA"]])
    r = by_key(score_vehicle_risk(build_master_kpi(tele, fuel, base_maintenance(spark))))
    assert r["VA"]["weighted_risk_score"] is None and r["VA"]["risk_category"] == "LOW"
    assert r["VA"]["priority_rank"] == 2 and r["KA"]["priority_rank"] == 1


def test_fleet_summary(spark):
    s = build_fleet_summary(_scored(spark), as_of_ts="2024-06-03 00:00:00").first()
    assert s["total_vehicles"] == 2
    assert s["vehicles_harsh_driving"] == 1 and s["vehicles_underutilised"] == 2
    assert s["vehicles_critical_risk"] == 0
    exp = round((s["fleet_avg_fuel_efficiency"] / 7.0 + s["fleet_avg_compliance_rate"]
                 + s["fleet_avg_utilisation_rate"]) / 3 * 100, 1)
    assert s["fleet_health_score"] == exp
    assert str(s["snapshot_timestamp"]) == "2024-06-03 00:00:00"


def test_driver_ranking_ascending_and_null_driver_dropped(spark):
    tele = telemetry_rows(spark, [
        dict(event_id="1", vehicle_id="V", driver_id="D1", event_timestamp=T(2024, 6, 1), speed_kmh=1.0,
             distance_km=100.0, harsh_braking=3, harsh_accel=0),
        dict(event_id="2", vehicle_id="V", driver_id="D2", event_timestamp=T(2024, 6, 1), speed_kmh=1.0,
             distance_km=100.0, harsh_braking=0, harsh_accel=0),
        dict(event_id="3", vehicle_id="V", driver_id="D3", event_timestamp=T(2024, 6, 1), speed_kmh=1.0,
             distance_km=100.0, harsh_braking=0, harsh_accel=0),
        dict(event_id="4", vehicle_id="V", driver_id=None, event_timestamp=T(2024, 6, 1), speed_kmh=1.0,
             distance_km=100.0, harsh_braking=9, harsh_accel=0),
    ])
    r = by_key(rank_drivers_by_behaviour(tele), "driver_id")
    assert set(r) == {"D1", "D2", "D3"}
    assert r["D2"]["driver_safety_rank"] == 1 and r["D3"]["driver_safety_rank"] == 1
    assert r["D1"]["driver_safety_rank"] == 3 and r["D1"]["driver_risk_flag"] == 1
