"""Adapters from the benchmark star schema to the fleet sources.

The benchmark tables are TPC-H-like plus an ``events`` stream; these
views re-read them as telemetry (events), fuel fills (lineitem),
maintenance records (orders) and the daily-log files (rollups joined to
customer and nation). Every mapping is a projection over the whole table:
one row out for each row in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vehicle_metrics.config import Thresholds

# Fixed values for the benchmark fleet: the events span 2024-01-01..30, so
# the observation window closes on 2024-01-31.
AS_OF_DATE = "2024-01-31"
AS_OF_TS = "2024-01-31 00:00:00"
# Three thresholds are moved so both sides of every rule have rows on this data.
BENCH_THRESHOLDS = Thresholds(utilisation_min_rate=0.85, harsh_severity_high_per_100km=1.7,
                              idling_minutes_daily_max=20.0)


# Columns the adapters read from each benchmark table. Passing the schema
# skips the footer-inference job on every read and prunes the scan.
BENCH_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "lineitem": ("l_orderkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                 "l_extendedprice DOUBLE, l_discount DOUBLE, l_shipdate TIMESTAMP_NTZ"),
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, "
               "o_orderpriority STRING"),
    "customer": "c_custkey BIGINT, c_nationkey INT, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in BENCH_SCHEMAS:
        reader = reader.schema(BENCH_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The mappings are SQL expressions: each projection is parsed once on the
# JVM side instead of being assembled column by column from Python.
TELEMETRY_EXPRS = [
    "CAST(event_id AS STRING) AS event_id",
    "CAST(user_id AS STRING) AS vehicle_id",
    "CASE WHEN event_id % 50 = 0 THEN CAST(NULL AS STRING)"
    " ELSE CAST(user_id + CASE WHEN event_id % 10 = 1 THEN 1 ELSE 0 END AS STRING) END AS driver_id",
    "ts AS event_timestamp",
    "CAST(-26.5 AS DOUBLE) + (event_id % 1000) / CAST(1000 AS DOUBLE) AS latitude",
    "CAST(27.5 AS DOUBLE) + (event_id % 1000) / CAST(1000 AS DOUBLE) AS longitude",
    "value AS speed_kmh",
    "CAST(NULL AS DOUBLE) AS odometer_km",
    "CAST(NULL AS INT) AS engine_rpm",
    "CASE WHEN event_type = 'error' THEN 3 ELSE 0 END AS harsh_braking",
    "CASE WHEN event_type = 'purchase' THEN 2 ELSE 0 END AS harsh_accel",
    "CASE WHEN event_type = 'view' THEN CAST(event_id % 20 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS idling_minutes",
    "CAST(1.5 AS DOUBLE) * CAST(get_json_object(props, '$.k') AS DOUBLE) AS distance_km",
]

FUEL_EXPRS = [
    "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS fuel_id",
    "CAST(l_suppkey AS STRING) AS vehicle_id",
    "l_shipdate AS fill_timestamp",
    "l_quantity * l_discount AS litres_filled",
    "l_extendedprice / CAST(1000 AS DOUBLE) AS cost_zar",
    "CAST(NULL AS DOUBLE) AS odometer_km",
    "CAST(NULL AS STRING) AS fuel_station_id",
]

MAINTENANCE_EXPRS = [
    "CAST(o_orderkey AS STRING) AS record_id",
    # Orders of every seventh customer belong to pool vehicles, so that some telemetry vehicles have no maintenance.
    "CASE WHEN o_custkey % 7 = 0 THEN concat('pool-', CAST(o_custkey % 10 AS STRING))"
    " ELSE CAST(o_custkey AS STRING) END AS vehicle_id",
    "to_date(o_orderdate) AS service_date",
    "o_orderpriority AS service_type",
    "o_totalprice AS next_service_km",
    f"date_add(DATE'{AS_OF_DATE}', CAST(o_orderkey % 106 - 15 AS INT)) AS next_service_date",
    "o_totalprice / CAST(100 AS DOUBLE) AS cost_zar",
    "CAST(o_orderkey % 5 AS STRING) AS workshop_id",
    "CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 1 END AS compliant",
]


def telemetry_from_events(events: DataFrame) -> DataFrame:
    return events.selectExpr(*TELEMETRY_EXPRS)


def fuel_from_lineitem(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(*FUEL_EXPRS)


def maintenance_from_orders(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(*MAINTENANCE_EXPRS)


#: Keys that some rows of the benchmark sources are made to lack, for the checked ingest.
TELEMETRY_FAULTS = {"event_id": "event_id % 101 = 5", "vehicle_id": "event_id % 211 = 7", "event_timestamp": "event_id % 307 = 11"}


def faulty_telemetry(events: DataFrame) -> DataFrame:
    """Telemetry whose keys are NULL in some rows."""
    blank = {c: f"CASE WHEN {cond} THEN NULL ELSE {c} END AS {c}" for c, cond in TELEMETRY_FAULTS.items()}
    rows = events.selectExpr("event_id AS _n", *TELEMETRY_EXPRS)
    return rows.selectExpr(*[blank[c].replace("event_id %", "_n %") if c in blank else c for c in rows.columns if c != "_n"])


def fuel_files(lineitem: DataFrame, path: str) -> list[str]:
    """Fuel fills written as headed CSV, with some records that cannot be
    read: litres that are no number, times that are none, and lines that end
    after the time. Returns the folders."""
    rows = lineitem.selectExpr("*", "(l_orderkey * 7 + l_linenumber) % 100 AS _n").selectExpr("_n", *FUEL_EXPRS)
    text = rows.selectExpr(
        "_n", "fuel_id", "vehicle_id",
        "CASE WHEN _n = 1 THEN 'not a time' ELSE date_format(fill_timestamp, \"yyyy-MM-dd'T'HH:mm:ss\") END AS fill_timestamp",
        "CASE WHEN _n = 2 THEN 'abc' ELSE CAST(litres_filled AS STRING) END AS litres_filled",
        "CAST(cost_zar AS STRING) AS cost_zar", "CAST(odometer_km AS STRING) AS odometer_km", "fuel_station_id")
    whole, short = f"{path}/whole", f"{path}/short"
    text.where("_n <> 3").drop("_n").write.option("header", "true").csv(whole)
    text.where("_n = 3").select("fuel_id", "vehicle_id", "fill_timestamp").write.option("header", "true").csv(short)
    return [whole, short]


def raw_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(telemetry, fuel, maintenance) before ingest cleaning."""
    return (
        telemetry_from_events(table(spark, sf_dir, "events")),
        fuel_from_lineitem(table(spark, sf_dir, "lineitem")),
        maintenance_from_orders(table(spark, sf_dir, "orders")),
    )


def daily_log_views(daily_telemetry: DataFrame, daily_fuel: DataFrame, maintenance: DataFrame,
                    customer: DataFrame, nation: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Daily-log shaped (telematics, fuel_logs, maintenance) from the rollups.

    nation has a fixed 25 rows, so broadcasting it is bounded; customer
    grows with the data and is left to the planner (AQE broadcasts it only
    after measuring it)."""
    dims = customer.join(F.broadcast(nation), customer["c_nationkey"] == nation["n_nationkey"], "left").selectExpr(
        "CAST(c_custkey AS STRING) AS vehicle_id", "c_mktsegment AS vehicle_type", "n_name AS route")
    telematics = daily_telemetry.join(dims, "vehicle_id", "left").selectExpr(
        "event_date AS date", "vehicle_id", "vehicle_type", "route", "daily_distance_km AS km_driven",
        "avg_speed_kmh", "daily_idling_minutes AS idle_minutes",
        "CAST(daily_harsh_events AS INT) AS harsh_braking_events",
    )
    fuel_logs = daily_fuel.selectExpr(
        "fill_date AS date", "vehicle_id", "daily_litres AS litres",
        "try_divide(daily_fuel_cost_zar, daily_litres) AS cost_per_litre", "daily_fuel_cost_zar AS total_cost",
    )
    maint = maintenance.selectExpr(
        "vehicle_id", "service_date AS scheduled_date", "service_type AS maintenance_type", "cost_zar AS cost",
        "CASE WHEN compliant = 1 THEN 'Y' ELSE 'N' END AS completed",
    )
    return telematics, fuel_logs, maint
