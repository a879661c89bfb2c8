"""Intermediate tables in the shared folder of the cluster.

``materialize`` writes a DataFrame as Parquet below the folder named by
``spark.checkpoint.dir`` and reads it back: the lineage is cut, later stages
read a compact columnar table with column pruning, and an executor lost
afterwards loses nothing, because the folder is shared by all executors and
the driver. Every folder is remembered per application, so a job that has
published its result can remove them with ``drop_materialized``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN_DIR_KEY = "spark.vehicle_metrics.localScratch"
_written: dict[str, list[str]] = {}
_probed: dict[tuple[str, str], str | None] = {}
PROBE_TASKS = 200


def _is_local(spark: SparkSession) -> bool:
    """True when driver and executors are one process."""
    master = spark.conf.get("spark.master", None) or ""
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; without one, or if it is not
    shared, the warehouse, which a cluster shares too, or else the folder given
    to ``setCheckpointDir``.

    Only a session in one process gets a temporary folder instead, without a
    checkpoint folder or if nothing can be written there (``vehicle_metrics``
    in it may be another user's). Whether a folder without a remote scheme is
    shared cannot be told from its name (a file system mounted on all machines
    has none), so it is tried once: see ``_probe``.
    """
    root = (spark.conf.get("spark.checkpoint.dir", None) or "").rstrip("/")
    if _is_local(spark):
        if not root or _fault(spark, root):
            root = spark.conf.get(_OWN_DIR_KEY, None)
        if not root:
            root = os.path.realpath(tempfile.mkdtemp(prefix="vehicle-metrics-"))
            spark.conf.set(_OWN_DIR_KEY, root)
        return root
    faults = {}
    for own in (root, spark.conf.get("spark.sql.warehouse.dir"), spark.sparkContext.getCheckpointDir()):
        if not own:
            continue
        own = own.rstrip("/")
        fault = _fault(spark, own)
        if not fault:
            return own
        faults[own] = fault
    for own in faults:  # to be tried again
        del _probed[_app(spark), own]
    raise RuntimeError(f"{'; '.join(faults.values())}; name a folder in spark.checkpoint.dir that driver and executors share")


def _fault(spark: SparkSession, root: str) -> str | None:
    """What ``_probe`` says; a folder with a remote scheme is not tried."""
    default_fs = spark.conf.get("spark.hadoop.fs.defaultFS", None) or "file:///"
    on_disk = root.startswith("file:") or (":/" not in root and default_fs.startswith("file:"))
    return _probe(spark, root) if on_disk else None


def _probe(spark: SparkSession, root: str) -> str | None:
    """Why the driver does not find in ``root`` what tasks have written there,
    None if it does; tried once per application and folder."""
    key = (_app(spark), root)
    if key not in _probed:
        n = min(spark.sparkContext.defaultParallelism, PROBE_TASKS)
        path = f"{root}/vehicle_metrics/probe-{uuid.uuid4().hex}"
        try:
            spark.range(0, n, 1, n).write.parquet(path)
            found = spark.read.schema("id long").parquet(path).count()
            _delete(spark, path)
            _probed[key] = None if found == n else f"{root} is not shared: of {n} rows written there by tasks the driver finds {found}"
        except Exception as error:  # no right to write there, or what was written is not found
            _probed[key] = f"{root} is not shared: {' '.join(str(error).split()[:60])}"
    return _probed[key]


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _app(spark: SparkSession) -> str:
    return spark.conf.get("spark.app.id", None) or "app"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared folder and return a scan of it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/vehicle_metrics/{_app(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.setdefault(_app(spark), []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_materialized(spark: SparkSession, since: int = 0) -> None:
    """Delete this application's intermediate tables written after the mark
    ``since`` (see ``written_so_far``). DataFrames that still read them fail
    afterwards, so call it once the final result is stored."""
    paths = _written.get(_app(spark), [])
    for path in paths[since:]:
        _delete(spark, path)
    del paths[since:]


def written_so_far(spark: SparkSession) -> int:
    """A mark for ``drop_materialized``."""
    return len(_written.get(_app(spark), []))
