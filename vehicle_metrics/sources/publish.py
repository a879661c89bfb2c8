"""Atomic publication of a set of tables (K2).

A run writes its tables under its own run id, where no reader looks, checks
what it has written, and then adds one manifest that names, for each table,
the folders that make it up. Readers take the newest manifest, so they see the
whole old set or the whole new one; a run that fails leaves the old set as it
was. A manifest's name is its number: two runs that finish at once cannot take
the same one, and the later one builds on the earlier one's.

A table with a partition column keeps the partitions that a run does not
replace. A run replaces those it has rows for and those it names, so a date
that has become empty disappears.

    <root>/_manifest/v00000007.json
    <root>/<table>/run=<id>/...                      unpartitioned
    <root>/<table>/<column>=<value>/run=<id>/...     partitioned
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vehicle_metrics.sources.sinks import FILES_PER_DATE, OUTPUT_LAYOUT

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's folder name for a NULL


class ValidationFailed(RuntimeError):
    """The staged tables did not pass; the published set is unchanged."""


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, time of change) of what lies in a folder, none if it is absent."""
    fs, target = _fs(spark, path)
    return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(target)] if fs.exists(target) else []


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def versions(spark: SparkSession, root: str) -> list[int]:
    names = [n for n, _ in _children(spark, f"{root.rstrip('/')}/_manifest")]
    return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))


def _manifest_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/_manifest/v{version:08d}.json"


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """The newest manifest, or that of ``version``; without any, an empty one."""
    if version is None:
        version = max(versions(spark, root), default=0)
    if not version:
        return {"version": 0, "run_id": None, "tables": {}, "notes": {}}
    return json.loads(spark.read.text(_manifest_path(root, version), wholetext=True).first()[0])


def _add_manifest(spark: SparkSession, root: str, content: dict) -> bool:
    """Put the manifest in place; False if its number is taken."""
    final = _manifest_path(root, content["version"])
    fs, target = _fs(spark, final)
    _, draft = _fs(spark, f"{root.rstrip('/')}/_manifest/_draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(content, indent=1, sort_keys=True).encode()))
    out.close()
    if not fs.exists(target) and fs.rename(draft, target):
        return True
    fs.delete(draft, False)
    return False


def _stage(df: DataFrame, root: str, name: str, run_id: str, fmt: str, partition_by: str | None) -> None:
    writer = df.write.format(fmt)
    if partition_by:
        spread = [F.pmod(F.xxhash64("vehicle_id"), F.lit(FILES_PER_DATE))] if "vehicle_id" in df.columns else []
        rows = df.withColumn("run", F.lit(run_id)).repartition(partition_by, *spread)
        writer = rows.write.format(fmt).mode("append").partitionBy(partition_by, "run")
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.save(f"{root}/{name}" if partition_by else f"{root}/{name}/run={run_id}")


def _staged_parts(spark: SparkSession, root: str, name: str, run_id: str, partition_by: str | None) -> dict[str, str]:
    """Partition value ("" for the whole table) -> folder written by a run."""
    if not partition_by:
        return {"": f"{name}/run={run_id}"}
    fs, pattern = _fs(spark, f"{root}/{name}/{partition_by}=*/run={run_id}")
    found = [s.getPath().getParent().getName() for s in (fs.globStatus(pattern) or [])]
    return {unquote(n.split("=", 1)[1]): f"{name}/{n}/run={run_id}" for n in found}


def _read(spark: SparkSession, root: str, name: str, entry: dict) -> DataFrame:
    schema = StructType.fromJson(entry["schema"])
    paths = [f"{root}/{p}" for _, p in sorted(entry["parts"].items())]
    if not paths:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).format(entry["format"])
    if entry["format"] == "csv":
        reader = reader.option("header", "true")
    if entry["partition_by"]:
        reader = reader.option("basePath", f"{root}/{name}")
    return reader.load(paths).select(*schema.fieldNames())


def publish(spark: SparkSession, tables: Mapping[str, DataFrame], root: str, fmt: str = "parquet",
            replace: Mapping[str, Sequence[str]] | None = None, layout: Mapping[str, Sequence[str]] = OUTPUT_LAYOUT,
            check: Callable[[dict[str, DataFrame]], DataFrame] | None = None, notes: Mapping | None = None,
            parallel_writes: int = 4, attempts: int = 20) -> dict:
    """Stage ``tables``, check them, and publish them together with what the
    newest manifest has of other tables and partitions; returns the manifest.

    ``replace`` names partition values that the run replaces even where it has
    no rows for them. ``check`` gets the staged tables, as written, and returns
    rows with a column ``passed``; if one is not passed the staged files are
    deleted and ``ValidationFailed`` is raised. ``notes`` are kept in the
    manifest, over those of the one before.
    """
    root, run_id = root.rstrip("/"), f"{time.strftime('%Y%m%dT%H%M%S')}-{uuid.uuid4().hex[:12]}"
    keys = {n: (layout.get(n) or (None,))[0] for n in tables}
    entries = {n: {"format": fmt, "partition_by": keys[n], "schema": json.loads(df.schema.json())} for n, df in tables.items()}
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallel_writes)) as pool:
            for job in [pool.submit(inheritable_thread_target(spark)(_stage), df, root, n, run_id, fmt, keys[n]) for n, df in tables.items()]:
                job.result()
        for n, entry in entries.items():
            entry["parts"] = _staged_parts(spark, root, n, run_id, keys[n])
        if check is not None:
            failed = [r.asDict() for r in check({n: _read(spark, root, n, e) for n, e in entries.items()}).where("NOT passed").collect()]
            if failed:
                raise ValidationFailed(f"output validation failed: {failed}")
        for _ in range(attempts):
            old = manifest(spark, root)
            merged = dict(old["tables"])
            for n, entry in entries.items():
                kept = merged[n]["parts"] if keys[n] and n in merged else {}
                gone = {str(v) for v in (replace or {}).get(n, ())}
                parts = {v: p for v, p in kept.items() if v not in gone}
                merged[n] = {**entry, "parts": {**parts, **entry["parts"]}}
            new = {"version": old["version"] + 1, "run_id": run_id, "tables": merged, "notes": {**old.get("notes", {}), **(notes or {})}}
            if _add_manifest(spark, root, new):
                return new
        raise RuntimeError(f"another run published each of {attempts} times")
    except BaseException:
        for n in tables:
            for path in _staged_parts(spark, root, n, run_id, keys[n]).values():
                _delete(spark, f"{root}/{path}")
        raise


def read_published(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A published table, of the newest set or of an earlier ``version``.
    Filters on its partition column prune whole folders."""
    found = manifest(spark, root, version)["tables"]
    if name not in found:
        raise KeyError(f"{name} is not published in {root}")
    return _read(spark, root.rstrip("/"), name, found[name])


def published_paths(root: str, content: dict) -> dict[str, str]:
    """Where each table of a manifest lies: its run's folder, or the folder of
    its partitions (which may hold other runs; read it with ``read_published``)."""
    return {n: f"{root.rstrip('/')}/{n}" if e["partition_by"] else f"{root.rstrip('/')}/{e['parts']['']}"
            for n, e in content["tables"].items()}


def vacuum(spark: SparkSession, root: str, keep: int = 2, min_age_hours: float = 24.0) -> list[str]:
    """Delete run folders that none of the newest ``keep`` manifests names and
    that are old enough not to be a run in progress; returns their paths."""
    root = root.rstrip("/")
    recent = versions(spark, root)[-keep:]
    named, tables = set(), set()
    for v in recent:
        for n, entry in manifest(spark, root, v)["tables"].items():
            tables.add((n, entry["partition_by"]))
            named |= set(entry["parts"].values())
    before, deleted = (time.time() - min_age_hours * 3600) * 1000, []
    for n, key in sorted(tables, key=str):
        folders = [f"{n}/{c}" for c, _ in _children(spark, f"{root}/{n}") if "=" in c] if key else [n]
        for folder in folders:
            for c, changed in _children(spark, f"{root}/{folder}"):
                if c.startswith("run=") and f"{folder}/{c}" not in named and changed <= before:
                    _delete(spark, f"{root}/{folder}/{c}")
                    deleted.append(f"{folder}/{c}")
    return deleted
