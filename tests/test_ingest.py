"""Ingest cleaning (S1-S5), deterministic dedupe, CSV/Parquet sources and sinks."""

import datetime as dt

from fixtures import D, T, by_key, maintenance_rows, telemetry_rows
from pyspark.sql import functions as F

from vehicle_metrics.schemas import TELEMETRY_SCHEMA
from vehicle_metrics.sources.ingest import (
    clean_fuel,
    dedupe_by_key,
    ingest_telemetry,
    validate_join_keys,
)
from vehicle_metrics.sources.sinks import write_outputs, write_table


def test_speed_range_and_null_speed_dropped(spark):
    rows = [dict(event_id=f"E{i}", vehicle_id="V1", event_timestamp=T(2024, 6, 1, 10), speed_kmh=s)
            for i, s in enumerate([None, 0.0, 200.0, 200.1, -0.5, 120.0])]
    kept = sorted(r["speed_kmh"] for r in telemetry_rows(spark, rows).collect())
    assert kept == [0.0, 120.0, 200.0]


def test_event_date_and_hour(spark):
    r = telemetry_rows(spark, [dict(event_id="E", vehicle_id="V", event_timestamp=T(2024, 12, 31, 23, 59),
                                    speed_kmh=1.0)]).first()
    assert r["event_date"] == D(2024, 12, 31) and r["event_hour"] == 23


def test_dedupe_is_deterministic_and_before_filter(spark):
    # Same event_id three times; the survivor is the earliest timestamp,
    # then the smallest remaining columns. It has an impossible speed, so
    # the key disappears entirely (dedupe runs before the range filter, D9).
    rows = [
        dict(event_id="E1", vehicle_id="V1", event_timestamp=T(2024, 6, 1, 9), speed_kmh=50.0),
        dict(event_id="E1", vehicle_id="V1", event_timestamp=T(2024, 6, 1, 8), speed_kmh=250.0),
        dict(event_id="E1", vehicle_id="V2", event_timestamp=T(2024, 6, 1, 9), speed_kmh=40.0),
        dict(event_id="E2", vehicle_id="V1", event_timestamp=T(2024, 6, 1, 9), speed_kmh=40.0),
        dict(event_id="E2", vehicle_id="V1", event_timestamp=T(2024, 6, 1, 9), speed_kmh=30.0),
    ]
    out = by_key(telemetry_rows(spark, rows), "event_id")
    assert set(out) == {"E2"}
    assert out["E2"]["speed_kmh"] == 30.0


def test_dedupe_matches_row_number_form(spark):
    from pyspark.sql import Window

    df = spark.range(0, 3000).select(
        (F.col("id") % 97).cast("string").alias("k"),
        (F.col("id") % 13).alias("a"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 5).alias("b"),
        F.col("id").alias("c"),
    )
    got = sorted(tuple(r) for r in dedupe_by_key(df, "k", ["a"]).collect())
    w = Window.partitionBy("k").orderBy(F.col("a").asc_nulls_first(), F.col("b").asc_nulls_first(),
                                        F.col("c").asc_nulls_first())
    exp = sorted(tuple(r) for r in df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
                 .collect())
    assert got == exp


def test_fuel_zero_litres_rejected_and_cost_per_litre(spark):
    from vehicle_metrics.schemas import FUEL_SCHEMA

    df = spark.createDataFrame([
        ("F1", "V1", T(2024, 6, 1), 0.0, 10.0, None, None),
        ("F2", "V1", T(2024, 6, 1), 4.0, 10.0, None, None),
        ("F3", "V1", T(2024, 6, 1), None, 10.0, None, None),
    ], FUEL_SCHEMA)
    out = by_key(clean_fuel(df), "fuel_id")
    assert set(out) == {"F2"} and out["F2"]["cost_per_litre"] == 2.5 and out["F2"]["fill_date"] == D(2024, 6, 1)


def test_maintenance_overdue_and_days(spark):
    m = by_key(maintenance_rows(spark, [
        dict(record_id="A", vehicle_id="V", service_date=D(2024, 1, 1), next_service_date=D(2024, 5, 31)),
        dict(record_id="B", vehicle_id="V", service_date=D(2024, 1, 1), next_service_date=D(2024, 6, 1)),
        dict(record_id="C", vehicle_id="V", service_date=D(2024, 1, 1), next_service_date=None),
    ], as_of="2024-06-01"), "record_id")
    assert (m["A"]["is_overdue"], m["A"]["days_until_service"]) == (1, -1)
    assert (m["B"]["is_overdue"], m["B"]["days_until_service"]) == (0, 0)
    assert (m["C"]["is_overdue"], m["C"]["days_until_service"]) == (0, None)


def test_validate_join_keys(spark):
    from fixtures import base_fuel, base_maintenance

    tele = telemetry_rows(spark, [
        dict(event_id=f"E{v}", vehicle_id=v, event_timestamp=T(2024, 6, 1), speed_kmh=1.0)
        for v in ["KA", "KB", "KC"]
    ])
    got = sorted(tuple(r) for r in validate_join_keys(tele, base_fuel(spark), base_maintenance(spark)).collect())
    assert got == [("KC", "no_fuel_records"), ("KC", "no_maintenance_records")]


def test_csv_and_parquet_sources_round_trip(spark, scratch):
    raw = spark.createDataFrame([
        ("E1", "V1", "D1", dt.datetime(2024, 6, 1, 8), -26.1, 27.9, 80.0, 1.0, 2000, 1, 0, 3.0, 12.5),
        ("E2", "V1", None, dt.datetime(2024, 6, 1, 9), None, None, 500.0, None, None, 0, 0, 0.0, 1.0),
    ], TELEMETRY_SCHEMA)
    write_table(raw, f"{scratch}/tele_csv", fmt="csv")
    write_table(raw, f"{scratch}/tele_pq")
    a = ingest_telemetry(spark, f"{scratch}/tele_csv", fmt="csv").collect()
    b = ingest_telemetry(spark, f"{scratch}/tele_pq").collect()
    assert [r.asDict() for r in a] == [r.asDict() for r in b]
    assert len(a) == 1 and a[0]["event_id"] == "E1"


def test_write_outputs_partitions(spark, scratch):
    from fixtures import base_telemetry

    from vehicle_metrics.operators.daily import aggregate_daily_telemetry

    daily = aggregate_daily_telemetry(base_telemetry(spark))
    paths = write_outputs({"daily_telemetry": daily}, scratch)
    back = spark.read.parquet(paths["daily_telemetry"])
    assert back.count() == daily.count()
    assert back.filter(F.col("event_date") == "2024-05-13").count() == 2
    import os
    assert any(p.startswith("event_date=") for p in os.listdir(paths["daily_telemetry"]))


def test_validate_join_keys_null_ids_compare_equal(spark):
    from pyspark.sql.types import StringType, StructField, StructType

    ids = StructType([StructField("vehicle_id", StringType(), True)])
    tele = spark.createDataFrame([(None,), ("V1",), ("V2",)], ids)
    fuel = spark.createDataFrame([(None,), ("V1",)], ids)
    maint = spark.createDataFrame([("V2",)], ids)
    got = sorted(validate_join_keys(tele, fuel, maint).collect(), key=lambda r: (str(r[0]), r[1]))
    exp_fuel = tele.subtract(fuel).collect()
    exp_maint = tele.subtract(maint).collect()
    exp = sorted([(r[0], "no_fuel_records") for r in exp_fuel] + [(r[0], "no_maintenance_records") for r in exp_maint],
                 key=lambda r: (str(r[0]), r[1]))
    assert [tuple(r) for r in got] == exp


def test_dedupe_of_declared_unique_keys_is_the_input(spark):
    df = spark.range(5).selectExpr("CAST(id AS STRING) AS k", "id AS a")
    assert dedupe_by_key(df, "k", ["a"], unique=True) is df


def test_adapters_keep_every_row(spark):
    from vehicle_metrics.sources import adapters

    sf = "/root/testdata/sf0.001"
    tele, fuel, maint = adapters.raw_sources(spark, sf)
    for name, df in (("events", tele), ("lineitem", fuel), ("orders", maint)):
        assert df.count() == adapters.table(spark, sf, name).count()
    assert tele.join(maint, "vehicle_id", "left_anti").count() > 0  # vehicles without maintenance


def test_two_daily_runs_keep_both_dates(spark, scratch):
    one = spark.sql("SELECT 'V1' AS vehicle_id, DATE'2024-06-01' AS alert_date")
    two = spark.sql("SELECT 'V2' AS vehicle_id, DATE'2024-06-02' AS alert_date")
    for df in (one, two, two):
        write_outputs({"alerts": df}, scratch)
    assert spark.read.parquet(f"{scratch}/alerts").count() == 2
