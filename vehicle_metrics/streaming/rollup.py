"""The daily rollup kept up to date by a stream (T1 into R1's table).

Each micro-batch is reduced to additive parts per vehicle and day and published
as a delta named by its batch id. The manifest is the ledger: a batch that is
replayed after a failure replaces its own delta, and one that was merged into
the base already is skipped, so every event counts once. ``compact`` merges
deltas into the base in one publication.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vehicle_metrics.config import DEFAULT_THRESHOLDS, Thresholds
from vehicle_metrics.operators.daily import daily_from_parts, daily_telemetry_parts
from vehicle_metrics.sources.publish import manifest, publish, read_published
from vehicle_metrics.streaming.telemetry import read_telemetry_stream, stream_clean_telemetry

BASE, DELTAS, MERGED = "rollup_base", "rollup_deltas", "merged_batch"
LAYOUT = {BASE: (), DELTAS: ("batch",)}

#: How two rows of parts of one vehicle and day are put together.
MERGE_SQL = [
    "sum(daily_distance_km) AS daily_distance_km",
    "sum(daily_harsh_braking) AS daily_harsh_braking",
    "sum(daily_harsh_accel) AS daily_harsh_accel",
    "sum(daily_idling_minutes) AS daily_idling_minutes",
    "sum(speed_sum) AS speed_sum",
    "sum(speed_count) AS speed_count",
    "max(max_speed_kmh) AS max_speed_kmh",
    "sum(event_count) AS event_count",
]


def merge_parts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("vehicle_id", "event_date").agg(*map(F.expr, MERGE_SQL))


def merge_batch(batch: DataFrame, batch_id: int, root: str) -> None:
    """Publish the parts of one micro-batch of cleaned telemetry; safe to repeat."""
    spark = batch.sparkSession
    if batch_id <= manifest(spark, root).get("notes", {}).get(MERGED, -1):
        return
    parts = daily_telemetry_parts(batch).withColumn("batch", F.lit(batch_id).cast("long"))
    publish(spark, {DELTAS: parts}, root, replace={DELTAS: [str(batch_id)]}, layout=LAYOUT)


def stored_rollup_parts(spark: SparkSession, root: str) -> DataFrame:
    """The parts of everything merged so far."""
    tables = manifest(spark, root)["tables"]
    found = [read_published(spark, root, n).drop("batch") for n in (BASE, DELTAS) if n in tables]
    if not found:
        raise KeyError(f"no batch was merged in {root}")
    return merge_parts(found[0] if len(found) == 1 else found[0].unionByName(found[1]))


def stored_rollup(spark: SparkSession, root: str) -> DataFrame:
    """R1 of everything merged so far."""
    return daily_from_parts(stored_rollup_parts(spark, root))


def compact(spark: SparkSession, root: str) -> None:
    """Merge all deltas into the base. Deltas published meanwhile have higher
    batch ids and stay."""
    batches = [int(b) for b in manifest(spark, root)["tables"].get(DELTAS, {"parts": {}})["parts"]]
    if not batches:
        return
    done = max(batches)
    deltas = read_published(spark, root, DELTAS).where(F.col("batch") <= done)
    old = [read_published(spark, root, BASE)] if BASE in manifest(spark, root)["tables"] else []
    base = merge_parts(deltas.drop("batch") if not old else old[0].unionByName(deltas.drop("batch")))
    publish(spark, {BASE: base, DELTAS: deltas.limit(0)}, root, replace={DELTAS: [str(b) for b in batches]}, layout=LAYOUT,
            notes={MERGED: done})


def start_rollup_stream(spark: SparkSession, source_path: str, root: str, checkpoint_location: str, fmt: str = "parquet",
                        thresholds: Thresholds = DEFAULT_THRESHOLDS, watermark: str = "1 day", available_now: bool = True,
                        max_files_per_trigger: int | None = None):
    """readStream (telemetry files) -> cleaning -> parts of each micro-batch,
    merged once each. The checkpoint records which files a batch id stands for,
    so a restarted query repeats an unfinished batch under its own id."""
    clean = stream_clean_telemetry(read_telemetry_stream(spark, source_path, fmt, max_files_per_trigger), watermark, thresholds)
    writer = (clean.writeStream.foreachBatch(lambda batch, batch_id: merge_batch(batch, batch_id, root))
              .option("checkpointLocation", checkpoint_location).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
