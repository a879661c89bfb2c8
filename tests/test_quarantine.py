"""Checked ingest: NULL keys and records that cannot be read go to rejects."""

import os

from fixtures import T, telemetry_rows
from pyspark.sql.types import StructField, StructType

from vehicle_metrics.schemas import FUEL_SCHEMA, TELEMETRY_SCHEMA
from vehicle_metrics.sources import clean_fuel, clean_telemetry, ingest_checked, ingest_telemetry, read_marked, stage_source
from vehicle_metrics.sources.quarantine import mark_rejects, required_columns


def _keyless(spark):
    at = T(2024, 6, 1)
    rows = [dict(event_id=None, vehicle_id="V1", event_timestamp=at, speed_kmh=float(i)) for i in range(5)]
    rows += [dict(event_id="E1", vehicle_id=None, event_timestamp=at, speed_kmh=1.0),
             dict(event_id="E2", vehicle_id=None, event_timestamp=None, speed_kmh=1.0),
             dict(event_id="E3", vehicle_id="V2", event_timestamp=at, speed_kmh=1.0),
             dict(event_id="E3", vehicle_id="V2", event_timestamp=at, speed_kmh=1.0)]
    nullable = StructType([StructField(f.name, f.dataType, True) for f in TELEMETRY_SCHEMA.fields])
    return spark.createDataFrame([tuple(r.get(n) for n in nullable.fieldNames()) for r in rows], nullable)


def test_rows_without_a_key_are_counted_and_kept_apart(spark, scratch):
    staged = stage_source(mark_rejects(_keyless(spark), TELEMETRY_SCHEMA), TELEMETRY_SCHEMA, os.path.join(scratch, "s"))
    assert staged.counts == {"rows_read": 9, "rows_rejected": 7, "malformed": 0, "null_event_id": 5, "null_vehicle_id": 2,
                             "null_event_timestamp": 1}
    reasons = sorted(r._reject_reason for r in staged.rejects.collect())
    assert reasons == ["null key: event_id"] * 5 + ["null key: vehicle_id", "null key: vehicle_id, event_timestamp"]
    assert staged.accepted.columns == TELEMETRY_SCHEMA.fieldNames()
    assert [r.event_id for r in clean_telemetry(staged.accepted).collect()] == ["E3"]


def test_rows_without_a_key_are_never_merged(spark):
    assert clean_telemetry(_keyless(spark)).where("event_id IS NULL").count() == 0
    assert clean_telemetry(_keyless(spark), unique=True).where("event_id IS NULL").count() == 5  # nothing is regrouped


def test_malformed_csv_records_keep_their_text(spark, scratch):
    path = os.path.join(scratch, "fuel.csv")
    lines = ["fuel_id,vehicle_id,fill_timestamp,litres_filled,cost_zar,odometer_km,fuel_station_id",
             "F1,V1,2024-06-01T08:00:00,40.0,800.0,,S1",
             "F2,V1,2024-06-01T08:00:00,abc,800.0,,S1",
             "F3,V1,yesterday,40.0,800.0,,S1",
             "F4,V1,2024-06-01T08:00:00",
             "F5,V1,2024-06-01T08:00:00,40.0,800.0,,S1,surplus",
             ",V1,2024-06-01T08:00:00,40.0,800.0,,S1",
             '"F6",V2,2024-06-02 09:30:00,20.5,410.0,1000.5,']
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    fuel, staged = ingest_checked(spark, path, FUEL_SCHEMA, clean_fuel, "csv", os.path.join(scratch, "s"))
    assert sorted(r.fuel_id for r in fuel.collect()) == ["F1", "F6"]
    rejects = {r._raw_record or r.vehicle_id: r._reject_reason for r in staged.rejects.collect()}
    assert rejects == {**{line: "malformed record" for line in lines[2:6]}, "V1": "null key: fuel_id"}
    assert all(r._source_file.endswith("fuel.csv") for r in staged.rejects.select("_source_file").collect())
    assert staged.counts["malformed"] == 4 and staged.counts["rows_rejected"] == 5 and staged.counts["rows_read"] == 7


def test_parquet_and_empty_sources(spark, scratch):
    good = telemetry_rows(spark, [dict(event_id="E1", vehicle_id="V1", event_timestamp=T(2024, 6, 1), speed_kmh=3.0)])
    good.select(*TELEMETRY_SCHEMA.fieldNames()).write.parquet(os.path.join(scratch, "t"))
    staged = stage_source(read_marked(spark, os.path.join(scratch, "t"), TELEMETRY_SCHEMA), TELEMETRY_SCHEMA)
    assert clean_telemetry(staged.accepted).collect() == ingest_telemetry(spark, os.path.join(scratch, "t")).collect()
    assert staged.rejects.count() == 0 and staged.counts["rows_read"] == 1
    empty = stage_source(mark_rejects(good.limit(0), TELEMETRY_SCHEMA), TELEMETRY_SCHEMA)
    assert empty.accepted.count() == 0 and empty.rejects.count() == 0 and empty.counts["rows_read"] == 0


def test_required_columns_are_the_declared_ones():
    assert required_columns(TELEMETRY_SCHEMA) == ["event_id", "vehicle_id", "event_timestamp"]
