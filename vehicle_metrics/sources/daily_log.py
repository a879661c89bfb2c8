"""Daily-log flat files (G1): one CSV per source with a header row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vehicle_metrics.schemas import (
    DAILY_LOG_FUEL_SCHEMA,
    DAILY_LOG_MAINTENANCE_SCHEMA,
    DAILY_LOG_TELEMATICS_SCHEMA,
)
from vehicle_metrics.sources.ingest import read_source


def read_daily_telematics(spark: SparkSession, path) -> DataFrame:
    return read_source(spark, path, DAILY_LOG_TELEMATICS_SCHEMA, fmt="csv")


def read_daily_fuel(spark: SparkSession, path) -> DataFrame:
    return read_source(spark, path, DAILY_LOG_FUEL_SCHEMA, fmt="csv")


def read_daily_maintenance(spark: SparkSession, path) -> DataFrame:
    return read_source(spark, path, DAILY_LOG_MAINTENANCE_SCHEMA, fmt="csv")
