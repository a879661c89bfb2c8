"""The daily rollup built run by run, and by a stream, equals one full run."""

import os
from datetime import date

from fixtures import T, telemetry_rows

from vehicle_metrics.operators.daily import aggregate_daily_telemetry
from vehicle_metrics.operators.reports import add_week_over_week
from vehicle_metrics.plans import incremental
from vehicle_metrics.schemas import TELEMETRY_SCHEMA
from vehicle_metrics.sources.ingest import clean_telemetry
from vehicle_metrics.sources.publish import manifest
from vehicle_metrics.streaming import compact, merge_batch, start_rollup_stream, stored_rollup


def _events(spark, spans):
    rows = [dict(event_id=f"E{d}-{i}", vehicle_id=f"V{i % 3}", driver_id="D", event_timestamp=T(2024, 6, d, 1 + i), speed_kmh=20.0 + i,
                 harsh_braking=i % 2, harsh_accel=1, idling_minutes=float(i), distance_km=1.5 * i) for d, n in spans for i in range(n)]
    return telemetry_rows(spark, rows).select(*TELEMETRY_SCHEMA.fieldNames())


def _rows(df):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect())


def test_day_by_day_equals_one_run_and_reads_new_dates_only(spark, scratch):
    root = os.path.join(scratch, "store")
    everything = _events(spark, [(1, 6), (2, 7), (3, 5)])
    for part, want in (("day(event_timestamp) = 1 AND event_id <> 'E1-4'", [1]), ("day(event_timestamp) = 2", [2]),
                       ("event_id = 'E1-4' OR day(event_timestamp) = 3", [1, 3])):
        assert incremental.advance(everything.where(part), root) == [date(2024, 6, d) for d in want]
    full = _rows(aggregate_daily_telemetry(clean_telemetry(everything)))
    assert _rows(incremental.stored_daily(spark, root)) == full
    # A batch that is landed twice changes nothing; one without events touches no date.
    incremental.advance(everything.where("day(event_timestamp) = 2"), root)
    assert incremental.advance(everything.limit(0), root) == []
    assert _rows(incremental.stored_daily(spark, root)) == full
    plan = incremental.landed_events(spark, root, [date(2024, 6, 3)])
    assert all("event_date=2024-06-03" in f for f in _read_files(plan)) and _read_files(plan)


def _read_files(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in text.split("PartitionFilters: [")[1].split("]")[0]
    return [r[0] for r in df.selectExpr("_metadata.file_path").distinct().collect()]


def test_a_replayed_batch_counts_once(spark, scratch):
    root = os.path.join(scratch, "rollup")
    clean = clean_telemetry(_events(spark, [(1, 6), (2, 7), (3, 5)]))
    first, second, third = (clean.where(f"pmod(hash(event_id), 3) = {k}") for k in range(3))
    merge_batch(first, 0, root)
    merge_batch(second, 1, root)
    merge_batch(second, 1, root)  # replayed
    compact(spark, root)
    merge_batch(first, 0, root)  # replayed after it was merged
    merge_batch(third, 2, root)
    full = _rows(aggregate_daily_telemetry(clean))
    assert _rows(stored_rollup(spark, root)) == full
    compact(spark, root)
    compact(spark, root)
    assert _rows(stored_rollup(spark, root)) == full and manifest(spark, root)["notes"]["merged_batch"] == 2


def test_stream_equals_batch_over_restarts(spark, scratch):
    source, root, checkpoint = (os.path.join(scratch, n) for n in ("in", "rollup", "ck"))
    events = _events(spark, [(1, 6), (2, 7), (3, 5)])
    events.where("day(event_timestamp) < 3").repartition(3).write.parquet(source)
    start_rollup_stream(spark, source, root, checkpoint, max_files_per_trigger=1, watermark="30 days").awaitTermination()
    events.where("day(event_timestamp) = 3").unionByName(events.where("event_id = 'E1-4'")).write.mode("append").parquet(source)
    start_rollup_stream(spark, source, root, checkpoint, watermark="30 days").awaitTermination()
    assert _rows(stored_rollup(spark, root)) == _rows(aggregate_daily_telemetry(clean_telemetry(events)))


def test_week_over_week_is_null_after_a_gap(spark):
    columns = "year int, iso_week int, weekly_distance_km double, weekly_harsh_events long, weekly_idling_minutes double, " \
              "active_vehicles long, fleet_harsh_per_100km double"
    trend = spark.createDataFrame([(2020, 52, 100.0, 4, 10.0, 3, 4.0), (2020, 53, 150.0, 3, 10.0, 4, 2.0), (2021, 1, 0.0, 0, 5.0, 1, None),
                                   (2021, 2, 30.0, 1, 5.0, 1, 3.33), (2021, 4, 60.0, 1, 5.0, 2, 1.67)], columns)
    got = [(r.iso_week, r.distance_km_change, r.harsh_events_change, r.active_vehicles_change, r.harsh_per_100km_change,
            r.distance_change_pct) for r in add_week_over_week(trend).collect()]
    assert got == [(52, None, None, None, None, None), (53, 50.0, -1, 1, -2.0, 50.0), (1, -150.0, -3, -3, None, -100.0),
                   (2, 30.0, 1, 0, None, None), (4, None, None, None, None, None)]
