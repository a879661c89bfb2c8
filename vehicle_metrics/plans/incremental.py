"""The daily rollup kept up to date day by day (R1 for A2, A4, A5, R3, P2).

Telemetry is landed by event date, and the rollup's additive parts are stored
by event date beside it. A run lands its batch, works out the parts of the
dates that the batch touches (new days, and old ones for late events) from the
landed events of just those dates, and publishes them: other dates are neither
read nor written. Landing a batch twice changes nothing, since events are
deduplicated within their date. An event has one timestamp, so its copies lie
in one date.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from vehicle_metrics.config import DEFAULT_THRESHOLDS, Thresholds
from vehicle_metrics.operators.daily import daily_from_parts, daily_telemetry_parts
from vehicle_metrics.schemas import TELEMETRY_SCHEMA
from vehicle_metrics.sources.ingest import clean_telemetry
from vehicle_metrics.sources.publish import manifest, publish, read_published
from vehicle_metrics.sources.quarantine import accepted_rows
from vehicle_metrics.sources.sinks import write_table
from vehicle_metrics.storage import drop_materialized, materialize, written_so_far

PARTS = "daily_parts"
LAYOUT = {PARTS: ("event_date",)}


def _landed(root: str) -> str:
    return f"{root.rstrip('/')}/landed_telemetry"


def land(batch: DataFrame, root: str) -> list[date]:
    """Append a batch of raw telemetry by event date; returns the dates it
    touches. Rows without a declared key are not landed (see ``quarantine``)."""
    spark = batch.sparkSession
    mark = written_so_far(spark)
    rows = accepted_rows(batch, TELEMETRY_SCHEMA).select(*TELEMETRY_SCHEMA.fieldNames())
    rows = materialize(rows.withColumn("event_date", F.to_date("event_timestamp")), "landing")
    dates = sorted(r.event_date for r in rows.select("event_date").distinct().collect())  # one row for each day
    write_table(rows, _landed(root), partition_by=("event_date",), mode="append")
    drop_materialized(spark, mark)
    return dates


def landed_events(spark: SparkSession, root: str, dates: Sequence[date]) -> DataFrame:
    """The landed events of ``dates``; the scan lists no other folder."""
    schema = StructType([*TELEMETRY_SCHEMA.fields, StructField("event_date", DateType())])
    rows = spark.read.schema(schema).parquet(_landed(root))
    return rows.where(F.col("event_date").isin(list(dates))).drop("event_date")


def refresh(spark: SparkSession, root: str, dates: Sequence[date], thresholds: Thresholds = DEFAULT_THRESHOLDS) -> None:
    """Work out the parts of ``dates`` again and publish them; a date left
    without events disappears."""
    parts = daily_telemetry_parts(clean_telemetry(landed_events(spark, root, dates), thresholds))
    publish(spark, {PARTS: parts}, root, replace={PARTS: [d.isoformat() for d in dates]}, layout=LAYOUT)


def advance(batch: DataFrame, root: str, thresholds: Thresholds = DEFAULT_THRESHOLDS) -> list[date]:
    """One run: land ``batch`` and refresh the dates that it touches."""
    dates = land(batch, root)
    if dates:
        refresh(batch.sparkSession, root, dates, thresholds)
    return dates


def stored_parts(spark: SparkSession, root: str) -> DataFrame:
    """The additive parts of all dates, as ``daily_telemetry_parts`` gives
    them; pass them to a ``FleetPlan`` as the override ``daily_parts``."""
    return read_published(spark, root, PARTS)


def stored_daily(spark: SparkSession, root: str) -> DataFrame:
    """R1 from the stored parts."""
    return daily_from_parts(stored_parts(spark, root))


def has_parts(spark: SparkSession, root: str) -> bool:
    return PARTS in manifest(spark, root)["tables"]
