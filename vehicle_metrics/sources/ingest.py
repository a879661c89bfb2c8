"""Source readers and ingest cleaning (telemetry, fuel, maintenance).

Reading and cleaning are separate steps: ``read_*`` scans a file set with
the fixed schema (Parquet by default, headed CSV as the flat-file variant)
and ``clean_*`` applies the ingest rules to any DataFrame of that shape.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vehicle_metrics.config import DEFAULT_THRESHOLDS, Thresholds
from vehicle_metrics.functions.exprs import date_sql, q, sql_double
from vehicle_metrics.schemas import FUEL_SCHEMA, MAINTENANCE_SCHEMA, TELEMETRY_SCHEMA


def read_source(spark: SparkSession, path, schema: StructType, fmt: str = "parquet",
                header: bool = True) -> DataFrame:
    """Scan ``path`` with an explicit schema. ``fmt`` is any Spark file format;
    CSV is read with a header row and without schema inference."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", str(header).lower()).option("encoding", "UTF-8")
    paths = [path] if isinstance(path, str) else list(path)
    return reader.format(fmt).load(paths)


def dedupe_by_key(df: DataFrame, key: str, order_by: Sequence[str] = (), unique: bool = False) -> DataFrame:
    """Keep exactly one row per ``key``, chosen deterministically.

    The survivor is the smallest row when compared on ``order_by`` first and
    then on every other column (ascending, NULLs first), computed as a
    grouped ``min`` over a struct: a partial aggregate collapses a key
    repeated millions of times before the shuffle, and a recomputed
    partition (lost executor) picks the same survivor. The plan is lazy and
    does not depend on the data. Rows without a key are not one entity, so
    they are never merged: they are left out here, and the checked ingest
    (``quarantine``) counts and keeps them as rejects.

    ``unique`` declares that the source has no repeated key (checked with
    ``validate_outputs``); the input is then returned as is, without a
    shuffle, and filters above reach the scan.
    """
    if unique:
        return df
    df = df.where(f"{q(key)} IS NOT NULL")
    rest = [c for c in df.columns if c != key and c not in order_by]
    ordering = ", ".join(q(c) for c in [*order_by, *rest])
    kept = df.groupBy(key).agg(F.expr(f"min(struct({ordering})) AS _keep"))
    return kept.selectExpr(*[q(c) if c == key else f"_keep.{q(c)} AS {q(c)}" for c in df.columns])


# -- S1 telemetry -------------------------------------------------------------

def clean_telemetry(df: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS,
                    unique: bool = False) -> DataFrame:
    """Dedupe on event_id, keep speeds inside the valid range (NULL speed is
    dropped too), add event_date and event_hour."""
    lo, hi = sql_double(thresholds.speed_valid_min_kmh), sql_double(thresholds.speed_valid_max_kmh)
    return (
        dedupe_by_key(df, "event_id", ["event_timestamp"], unique)
        .where(f"speed_kmh BETWEEN {lo} AND {hi}")
        .selectExpr("*", "to_date(event_timestamp) AS event_date", "hour(event_timestamp) AS event_hour")
    )


def ingest_telemetry(spark: SparkSession, path, fmt: str = "parquet",
                     thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    return clean_telemetry(read_source(spark, path, TELEMETRY_SCHEMA, fmt), thresholds)


# -- S2 fuel ------------------------------------------------------------------

def clean_fuel(df: DataFrame, unique: bool = False) -> DataFrame:
    """Dedupe on fuel_id, reject fills without litres, add fill_date and
    cost_per_litre."""
    return (
        dedupe_by_key(df, "fuel_id", ["fill_timestamp"], unique)
        .where("litres_filled > 0")
        .selectExpr("*", "to_date(fill_timestamp) AS fill_date",
                    "try_divide(cost_zar, litres_filled) AS cost_per_litre")
    )


def ingest_fuel(spark: SparkSession, path, fmt: str = "parquet") -> DataFrame:
    return clean_fuel(read_source(spark, path, FUEL_SCHEMA, fmt))


# -- S3 maintenance -----------------------------------------------------------

def clean_maintenance(df: DataFrame, as_of_date=None) -> DataFrame:
    """Dedupe on record_id; is_overdue = next service before the as-of date
    (NULL date -> 0); days_until_service = days from as-of to next service."""
    as_of = date_sql(as_of_date)
    return dedupe_by_key(df, "record_id", ["service_date"]).selectExpr(
        "*",
        f"CASE WHEN next_service_date < {as_of} THEN 1 ELSE 0 END AS is_overdue",
        f"datediff(next_service_date, {as_of}) AS days_until_service",
    )


def ingest_maintenance(spark: SparkSession, path, fmt: str = "parquet", as_of_date=None) -> DataFrame:
    return clean_maintenance(read_source(spark, path, MAINTENANCE_SCHEMA, fmt), as_of_date)


# -- S5 source coverage -------------------------------------------------------

def validate_join_keys(telemetry_df: DataFrame, fuel_df: DataFrame, maintenance_df: DataFrame) -> DataFrame:
    """Vehicles seen in telemetry without fuel rows / without maintenance rows
    (EXCEPT DISTINCT semantics: NULL ids compare equal).

    One aggregate: each source gives its vehicle ids with a bit of its own;
    grouped by id (partial aggregates, so a vehicle owning a large share of
    rows costs one row per map partition), the bits say which sources have it.
    """
    ids = telemetry_df.selectExpr("vehicle_id", "1 AS t", "0 AS f", "0 AS m").unionByName(
        fuel_df.selectExpr("vehicle_id", "0 AS t", "1 AS f", "0 AS m")).unionByName(
        maintenance_df.selectExpr("vehicle_id", "0 AS t", "0 AS f", "1 AS m"))
    seen = ids.groupBy("vehicle_id").agg(*[F.expr(f"max({c}) AS {c}") for c in "tfm"]).where("t = 1")
    return seen.selectExpr("vehicle_id", "explode(array_compact(array("
                           "CASE WHEN f = 0 THEN 'no_fuel_records' END, "
                           "CASE WHEN m = 0 THEN 'no_maintenance_records' END))) AS issue")
