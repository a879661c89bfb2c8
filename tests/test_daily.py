"""Daily rollups and the trailing window."""

from fixtures import T, base_telemetry, telemetry_rows

from vehicle_metrics.operators.daily import aggregate_daily_telemetry, compute_rolling_kpis


def test_daily_rollup(spark):
    d = {(r["vehicle_id"], str(r["event_date"])): r for r in aggregate_daily_telemetry(base_telemetry(spark)).collect()}
    r = d[("KA", "2024-05-13")]
    assert (r["daily_distance_km"], r["daily_harsh_events"], r["event_count"], r["max_speed_kmh"]) == (80.0, 3, 2, 70.0)
    assert set(d) == {("KA", "2024-05-13"), ("KA", "2024-05-14"), ("KB", "2024-05-13"), ("KB", "2024-05-20"),
                      ("KB", "2024-05-29")}


def test_rolling_window_is_seven_calendar_days(spark):
    # values 1, 2, 4 on Jun 1, 7, 8: trailing 7-day sums 1, 3, 6
    rows = [dict(event_id=str(i), vehicle_id="V", event_timestamp=T(2024, 6, day), speed_kmh=1.0,
                 distance_km=float(v), harsh_braking=v, harsh_accel=0)
            for i, (day, v) in enumerate([(1, 1), (7, 2), (8, 4)])]
    out = compute_rolling_kpis(aggregate_daily_telemetry(telemetry_rows(spark, rows))).orderBy("event_date")
    got = [(r["rolling_7d_distance_km"], r["rolling_7d_harsh_events"]) for r in out.collect()]
    assert got == [(1.0, 1), (3.0, 3), (6.0, 6)]


def test_rolling_flag(spark):
    rows = [dict(event_id="1", vehicle_id="V", event_timestamp=T(2024, 6, 1), speed_kmh=1.0,
                 distance_km=100.0, harsh_braking=2, harsh_accel=0)]
    r = compute_rolling_kpis(aggregate_daily_telemetry(telemetry_rows(spark, rows))).first()
    assert r["rolling_7d_harsh_per_100km"] == 2.0 and r["behaviour_trend_flag"] == 1


def test_iso_week_year_end(spark):
    from vehicle_metrics.operators.reports import build_fleet_trend_report

    rows = [dict(event_id=str(i), vehicle_id="V", event_timestamp=T(*ymd), speed_kmh=1.0, distance_km=10.0,
                 harsh_braking=0, harsh_accel=0)
            for i, ymd in enumerate([(2024, 12, 30), (2025, 1, 2), (2024, 12, 27)])]
    rep = build_fleet_trend_report(aggregate_daily_telemetry(telemetry_rows(spark, rows)))
    got = [(r["year"], r["iso_week"], r["weekly_distance_km"]) for r in rep.collect()]
    # 2024-12-30 is in ISO week 1 of 2025, grouped with 2025-01-02
    assert got == [(2024, 52, 10.0), (2025, 1, 20.0)]
