"""Sinks (K1, K2): overwrite a table, or write the curated output set.

Writes are partitioned, never funnelled through ``coalesce(1)``: every
task writes its own files, and a failed task is retried by Spark with the
job committed atomically by the output committer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILES_PER_DATE = 16

# Curated outputs and how each is laid out on storage.
OUTPUT_LAYOUT: dict[str, Sequence[str]] = {
    "kpi_master": (),
    "alerts": ("alert_date",),
    "fleet_summary": (),
    "driver_ranking": (),
    "daily_telemetry": ("event_date",),
}


def _files(df: DataFrame, folder: str) -> set[str]:
    """The names of the data files in a folder, none if it is absent."""
    spark = df.sparkSession
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in fs.listStatus(target)} if fs.exists(target) else set()


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "overwrite", replaces: Sequence[str] = ()) -> None:
    """K1: overwrite ``path``. CSV gets a header row.

    A partitioned table keeps the partitions that ``df`` has no rows for
    (dynamic overwrite), so a daily run replaces its own dates only. Its rows
    are first dealt by date and a few hash buckets of the vehicle: a date has
    at most FILES_PER_DATE files, and no date goes through one task.

    ``replaces`` names values of the first partition column that are replaced
    even where ``df`` has no rows for them: a rerun of a day that has become
    empty empties its partition. (``publish`` does the same for a whole set,
    and atomically.)
    """
    named = [f"{path.rstrip('/')}/{partition_by[0]}={v}" for v in replaces] if partition_by else []
    before = {folder: _files(df, folder) for folder in named}
    if partition_by:
        spread = [F.pmod(F.xxhash64("vehicle_id"), F.lit(FILES_PER_DATE))] if "vehicle_id" in df.columns else []
        df = df.repartition(*partition_by, *spread)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.save(path)
    for folder, files in before.items():
        if files and _files(df, folder) == files:  # nothing new was written there
            target = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            target.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def write_bucketed(df: DataFrame, table: str, path: str, key: str = "vehicle_id", buckets: int = 64) -> DataFrame:
    """A curated table as Parquet at ``path``, dealt into ``buckets`` by the
    hash of ``key`` and sorted by it, and registered under ``table``: tables
    with the same key and number of buckets are joined and grouped by the key
    without an exchange. Rows are dealt before they are written, so each bucket
    is one file."""
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    return df.sparkSession.table(table)


def write_outputs(tables: Mapping[str, DataFrame], root: str, fmt: str = "parquet",
                  parallel_writes: int = 4) -> dict[str, str]:
    """K2: write each named table under ``root/<name>``; daily telemetry is
    partitioned by event_date and alerts by alert_date, so date filters
    prune whole directories on read.

    The tables are independent, so up to ``parallel_writes`` write jobs are
    submitted at once (Spark schedules concurrent jobs of one session), and
    a small table does not leave the cluster idle while it commits.
    """
    paths = {name: f"{root.rstrip('/')}/{name}" for name in tables}

    def write(name: str) -> None:
        write_table(tables[name], paths[name], fmt, OUTPUT_LAYOUT.get(name, ()))

    if parallel_writes <= 1 or len(tables) <= 1:
        for name in tables:
            write(name)
    else:
        with ThreadPoolExecutor(max_workers=parallel_writes) as pool:
            for future in [pool.submit(inheritable_thread_target(write), name) for name in tables]:
                future.result()
    return paths


def write_reports(reports: Mapping[str, DataFrame], root: str) -> dict[str, str]:
    """Report tables (P1-P5) as headed CSV under ``root/<name>`` for export
    (spreadsheets, BI tools). Reports are small, per-entity or per-group
    tables; each is written by as many tasks as it has partitions."""
    paths = {name: f"{root.rstrip('/')}/{name}" for name in reports}
    with ThreadPoolExecutor(max_workers=4) as pool:
        for future in [pool.submit(inheritable_thread_target(write_table), df, paths[name], "csv")
                       for name, df in reports.items()]:
            future.result()
    return paths
