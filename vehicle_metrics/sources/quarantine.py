"""Checked ingest: rows that cannot be trusted go to a quarantine table.

A row is rejected when a column that its schema declares non-null is NULL, or
when a text record could not be read with the schema (a field of the wrong
type, a bad time, missing or surplus fields). ``stage_source`` writes accepted
and rejected rows in one pass over the source, side by side, and counts both
in that pass; a rejected row carries its reason, its file and, from a text
source, the record as it stood there. Nothing is merged or dropped.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from vehicle_metrics.functions.exprs import q, sql_str
from vehicle_metrics.storage import shared_folder

RECORD, FILE, REASON, REJECTED = "_raw_record", "_source_file", "_reject_reason", "_rejected"
MALFORMED = "malformed record"


def required_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


def mark_rejects(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with _raw_record and _source_file (NULL where it has none) and
    _reject_reason, which is NULL for a row that is accepted."""
    for name in (RECORD, FILE):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    required = required_columns(schema)
    missing = ", ".join(f"CASE WHEN {q(c)} IS NULL THEN {sql_str(c)} END" for c in required)
    any_missing = " OR ".join(f"{q(c)} IS NULL" for c in required) or "false"
    keys = f"concat('null key: ', concat_ws(', ', {missing}))" if required else "CAST(NULL AS STRING)"
    reason = f"CASE WHEN {RECORD} IS NOT NULL THEN {sql_str(MALFORMED)} WHEN {any_missing} THEN {keys} END"
    return df.selectExpr(*[q(f.name) for f in schema.fields], RECORD, FILE, f"{reason} AS {REASON}")


def accepted_rows(df: DataFrame, schema: StructType) -> DataFrame:
    """The rows of ``df`` whose declared non-null columns are all there."""
    required = required_columns(schema)
    return df.where(" AND ".join(f"{q(c)} IS NOT NULL" for c in required)) if required else df


def read_marked(spark: SparkSession, path, schema: StructType, fmt: str = "parquet", header: bool = True) -> DataFrame:
    """Scan ``path`` and mark its rejects. CSV is read permissively: a record
    that does not fit the schema keeps its raw text."""
    paths = [path] if isinstance(path, str) else list(path)
    if fmt == "csv":
        fields = [StructField(f.name, f.dataType, True) for f in schema.fields]
        reader = (spark.read.schema(StructType([*fields, StructField(RECORD, StringType(), True)]))
                  .option("header", str(header).lower()).option("encoding", "UTF-8").option("mode", "PERMISSIVE")
                  .option("columnNameOfCorruptRecord", RECORD))
    else:
        reader = spark.read.schema(schema)
    return mark_rejects(reader.format(fmt).load(paths).withColumn(FILE, F.col("_metadata.file_path")), schema)


@dataclass(frozen=True)
class StagedSource:
    """A source split in two stored tables, and what was counted on the way:
    rows_read, rows_rejected, malformed and null_<column>."""
    accepted: DataFrame
    rejects: DataFrame
    counts: dict[str, int]
    path: str


def stage_source(marked: DataFrame, schema: StructType, path: str | None = None) -> StagedSource:
    """Write ``marked`` (see ``read_marked``) once, rejects apart, and read
    both parts back. ``path`` defaults to a new folder in the shared one."""
    spark = marked.sparkSession
    path = path or f"{shared_folder(spark)}/vehicle_metrics/staged-{uuid.uuid4().hex}"
    seen = Observation(f"staged-{uuid.uuid4().hex}")
    metrics = [F.count(F.lit(1)).alias("rows_read"), F.count_if(F.col(REASON).isNotNull()).alias("rows_rejected"),
               F.count_if(F.col(RECORD).isNotNull()).alias("malformed"),
               *[F.count_if(F.col(RECORD).isNull() & F.col(c).isNull()).alias(f"null_{c}") for c in required_columns(schema)]]
    (marked.observe(seen, *metrics).withColumn(REJECTED, F.col(REASON).isNotNull())
     .write.mode("overwrite").partitionBy(REJECTED).parquet(path))
    counts = {m: seen.get.get(m, 0) for m in ("rows_read", "rows_rejected", "malformed", *(f"null_{c}" for c in required_columns(schema)))}
    stored = spark.read.schema(StructType([*marked.schema.fields, StructField(REJECTED, BooleanType())])).parquet(path)
    return StagedSource(stored.where(f"NOT {REJECTED}").drop(RECORD, FILE, REASON, REJECTED),
                        stored.where(REJECTED).drop(REJECTED), counts, path)


def ingest_checked(spark: SparkSession, path, schema: StructType, clean, fmt: str = "parquet",
                   staged_path: str | None = None) -> tuple[DataFrame, StagedSource]:
    """Read, split and clean a source: (cleaned rows, what was staged).
    ``clean`` is one of the ingest rules, e.g. ``clean_telemetry``."""
    staged = stage_source(read_marked(spark, path, schema, fmt), schema, staged_path)
    return clean(staged.accepted), staged
