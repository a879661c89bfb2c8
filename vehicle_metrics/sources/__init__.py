from vehicle_metrics.sources.ingest import (
    clean_fuel,
    clean_maintenance,
    clean_telemetry,
    dedupe_by_key,
    ingest_fuel,
    ingest_maintenance,
    ingest_telemetry,
    read_source,
    validate_join_keys,
)
from vehicle_metrics.sources.publish import publish, read_published, vacuum
from vehicle_metrics.sources.quarantine import ingest_checked, read_marked, stage_source

__all__ = [
    "clean_fuel",
    "clean_maintenance",
    "clean_telemetry",
    "dedupe_by_key",
    "ingest_checked",
    "ingest_fuel",
    "ingest_maintenance",
    "ingest_telemetry",
    "publish",
    "read_marked",
    "read_published",
    "read_source",
    "stage_source",
    "vacuum",
    "validate_join_keys",
]
