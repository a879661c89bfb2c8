"""Publication: whole sets, replaced dates, failed checks, old versions; and
the replaced dates of a plain table; bucketed tables."""

import os
import sys

import pytest
from pyspark.sql import functions as F

from vehicle_metrics.operators.validation import validate_outputs
from vehicle_metrics.plans.fleet import FleetPlan, run_daily_batch
from vehicle_metrics.sources.publish import ValidationFailed, manifest, publish, read_published, vacuum, versions
from vehicle_metrics.sources.sinks import write_bucketed, write_table

SF = "/root/testdata/sf0.001"


def _alerts(spark, rows):
    return spark.createDataFrame(rows, "alert_id string, vehicle_id string, alert_date date")


def _day(spark, day, ids):
    df = spark.createDataFrame([(i, f"V{i}") for i in ids], "alert_id string, vehicle_id string")
    return df.withColumn("alert_date", F.lit(day).cast("date"))


def _ids(df):
    return sorted((str(r.alert_date), r.alert_id) for r in df.collect())


def test_a_rerun_day_that_became_empty_is_emptied(spark, scratch):
    for replace in (publish, None):
        root = os.path.join(scratch, "p" if replace else "t")

        def write(day, ids):
            df = _day(spark, day, ids)
            if replace:
                publish(spark, {"alerts": df}, root, replace={"alerts": [day]})
            else:
                write_table(df, root, partition_by=("alert_date",), replaces=[day])

        def read():
            return read_published(spark, root, "alerts") if replace else spark.read.parquet(root)

        write("2024-06-01", ["a", "b"])
        write("2024-06-02", ["c"])
        assert _ids(read()) == [("2024-06-01", "a"), ("2024-06-01", "b"), ("2024-06-02", "c")]
        write("2024-06-01", ["z"])
        assert _ids(read()) == [("2024-06-01", "z"), ("2024-06-02", "c")]
        write("2024-06-01", [])
        assert _ids(read()) == [("2024-06-02", "c")]


def test_a_failed_check_leaves_the_old_set(spark, scratch):
    root = os.path.join(scratch, "out")
    kpi = spark.createDataFrame([("A", 1), ("B", 2)], "vehicle_id string, x int")
    publish(spark, {"kpi_master": kpi, "alerts": _day(spark, "2024-06-01", ["a"])}, root, check=validate_outputs)
    before = manifest(spark, root)
    with pytest.raises(ValidationFailed):
        publish(spark, {"kpi_master": kpi.union(kpi), "alerts": _day(spark, "2024-06-01", ["b"])}, root, check=validate_outputs)
    assert manifest(spark, root) == before
    assert read_published(spark, root, "kpi_master").count() == 2 and _ids(read_published(spark, root, "alerts")) == [("2024-06-01", "a")]
    runs = [d for d, _, _ in os.walk(root) if "run=" in d]
    assert all(before["run_id"] in d for d in runs)  # what the failed run staged is gone


def test_an_error_while_writing_publishes_nothing(spark, scratch):
    root = os.path.join(scratch, "out")
    bad = spark.range(3).selectExpr("CAST(raise_error('no') AS STRING) AS vehicle_id")
    with pytest.raises(Exception, match="no"):
        publish(spark, {"kpi_master": bad}, root)
    assert versions(spark, root) == []


def test_versions_csv_empty_tables_and_vacuum(spark, scratch):
    root = os.path.join(scratch, "out")
    for n in range(3):
        publish(spark, {"kpi_master": spark.createDataFrame([("A,\"x\"", n, None)], "vehicle_id string, x int, d date"),
                        "alerts": _day(spark, "2024-06-01", ["a"]).limit(n)}, root, "csv")
    assert versions(spark, root) == [1, 2, 3]
    assert [read_published(spark, root, "kpi_master", v).first().x for v in (1, 2, 3)] == [0, 1, 2]
    assert tuple(read_published(spark, root, "kpi_master").first()) == ('A,"x"', 2, None)
    assert [read_published(spark, root, "alerts", v).count() for v in (1, 3)] == [0, 1]
    assert vacuum(spark, root, keep=1) == []  # too young to go
    assert len(vacuum(spark, root, keep=1, min_age_hours=0)) == 3
    assert read_published(spark, root, "kpi_master").first().x == 2 and read_published(spark, root, "alerts").count() == 1
    with pytest.raises(KeyError):
        read_published(spark, root, "nothing")


def test_a_run_builds_on_one_that_published_meanwhile(spark, scratch, monkeypatch):
    module = sys.modules[publish.__module__]
    root, real, raced = os.path.join(scratch, "out"), module._add_manifest, []

    def race(spark_, root_, content):
        if not raced:
            raced.append(True)
            publish(spark, {"fleet_summary": spark.range(1)}, root)
        return real(spark_, root_, content)

    monkeypatch.setattr(module, "_add_manifest", race)
    publish(spark, {"driver_ranking": spark.range(2)}, root)
    assert set(manifest(spark, root)["tables"]) == {"fleet_summary", "driver_ranking"} and versions(spark, root) == [1, 2]


def test_published_dates_are_pruned(spark, scratch):
    root = os.path.join(scratch, "out")
    for day in ("2024-06-01", "2024-06-02"):
        publish(spark, {"alerts": _day(spark, day, ["a"])}, root)
    found = read_published(spark, root, "alerts").where("alert_date = '2024-06-02'")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(alert_date" in plan and _ids(found) == [("2024-06-02", "a")]


def test_daily_batch_keeps_the_old_set_when_its_check_fails(spark, scratch):
    if not os.path.isdir(SF):
        pytest.skip("test data not present")
    root = os.path.join(scratch, "out")
    run_daily_batch(spark, FleetPlan.from_testdata(spark, SF), root)
    before = read_published(spark, root, "kpi_master").count()
    empty = FleetPlan.from_testdata(spark, SF)
    empty.raw_fuel = FleetPlan.from_testdata(spark, SF).raw_fuel().limit(0)  # no vehicle has fuel: no master rows
    with pytest.raises(ValidationFailed):
        run_daily_batch(spark, empty, root)
    assert read_published(spark, root, "kpi_master").count() == before > 0


def test_bucketed_tables_join_without_an_exchange(spark, scratch):
    def rows(n, name):
        return spark.range(n).selectExpr("CAST(id % 50 AS STRING) AS vehicle_id", f"id AS {name}")

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = write_bucketed(rows(50, "x"), "vm_test_a", os.path.join(scratch, "a"), buckets=4)
        b = write_bucketed(rows(200, "y"), "vm_test_b", os.path.join(scratch, "b"), buckets=4)
        joined = a.join(b.groupBy("vehicle_id").agg(F.sum("y").alias("y")), "vehicle_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" in plan
        plain = rows(50, "x").join(rows(200, "y").groupBy("vehicle_id").agg(F.sum("y").alias("y")), "vehicle_id")
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, plain.collect()))
        assert len([f for f in os.listdir(os.path.join(scratch, "b")) if f.endswith(".parquet")]) == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS vm_test_a")
        spark.sql("DROP TABLE IF EXISTS vm_test_b")
