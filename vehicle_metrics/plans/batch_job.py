"""Daily batch job for spark-submit.

    spark-submit --py-files vehicle_metrics.zip vehicle_metrics/plans/batch_job.py \\
        --telemetry s3://bucket/telemetry/ --fuel s3://bucket/fuel/ \\
        --maintenance s3://bucket/maintenance/ --out s3://bucket/curated/ \\
        --as-of-date 2024-06-30 [--format parquet|csv] [--observation-days 30]

Reads the three sources with their fixed schemas, cleans them, and writes
kpi_master, alerts, fleet_summary, driver_ranking and daily_telemetry
under ``--out`` (see ``run_daily_batch``). Intermediates are materialised
under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import dataclasses
import json

from pyspark.sql import SparkSession

from vehicle_metrics.config import DEFAULT_THRESHOLDS
from vehicle_metrics.plans.fleet import FleetPlan, run_daily_batch
from vehicle_metrics.schemas import FUEL_SCHEMA, MAINTENANCE_SCHEMA, TELEMETRY_SCHEMA
from vehicle_metrics.sources.ingest import read_source
from vehicle_metrics.sources.quarantine import read_marked, stage_source


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="vehicle_metrics daily batch")
    p.add_argument("--telemetry", required=True)
    p.add_argument("--fuel", required=True)
    p.add_argument("--maintenance", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--format", default="parquet", help="input format (parquet or csv)")
    p.add_argument("--output-format", default="parquet")
    p.add_argument("--reports-out", default=None, help="also write the reports as CSV under this path")
    p.add_argument("--as-of-date", default=None, help="YYYY-MM-DD; default: today")
    p.add_argument("--as-of-ts", default=None, help="'YYYY-MM-DD HH:MM:SS'; default: now")
    p.add_argument("--rejects-out", default=None,
                   help="check the sources first, and keep rows without a key and malformed records under this path")
    p.add_argument("--unique-telemetry", action="store_true", help="event_id does not repeat (checked by --rejects-out or X3)")
    p.add_argument("--unique-fuel", action="store_true", help="fuel_id does not repeat")
    p.add_argument("--observation-days", type=int, default=DEFAULT_THRESHOLDS.observation_days)
    return p.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None) -> dict[str, str]:
    args = parse_args(argv)
    spark = spark or SparkSession.builder.appName("vehicle_metrics_daily_batch").getOrCreate()
    thresholds = dataclasses.replace(DEFAULT_THRESHOLDS, observation_days=args.observation_days)
    counts = {}

    def source(name: str, path: str, schema):
        if not args.rejects_out:
            return lambda: read_source(spark, path, schema, args.format)
        staged = stage_source(read_marked(spark, path, schema, args.format), schema, f"{args.rejects_out.rstrip('/')}/{name}")
        counts[name] = staged.counts
        return staged.accepted

    plan = FleetPlan(
        source("telemetry", args.telemetry, TELEMETRY_SCHEMA),
        source("fuel", args.fuel, FUEL_SCHEMA),
        source("maintenance", args.maintenance, MAINTENANCE_SCHEMA),
        as_of_date=args.as_of_date, as_of_ts=args.as_of_ts, thresholds=thresholds,
        unique_telemetry=args.unique_telemetry, unique_fuel=args.unique_fuel,
    )
    if counts:
        print(json.dumps({"sources": counts}))
    paths = run_daily_batch(spark, plan, args.out, args.output_format, reports_root=args.reports_out)
    print(json.dumps(paths))
    return paths


if __name__ == "__main__":
    main()
