"""The shared folder on a cluster: what is configured is used, and tried once."""

import os
import types

import pytest

from vehicle_metrics import storage


class Elsewhere:
    """The session of the tests under another master and with other settings."""

    def __init__(self, spark, **conf):
        self.spark = spark
        own = {"spark.master": "spark://host:7077", "spark.checkpoint.dir": None} | {k.replace("_", "."): v for k, v in conf.items()}
        self.conf = types.SimpleNamespace(get=lambda k, *other: own[k] if k in own else spark.conf.get(k, *other))

    def __getattr__(self, name):
        return getattr(self.spark, name)


@pytest.mark.parametrize("scheme", ["", "file://"])
@pytest.mark.parametrize("master", ["spark://host:7077", "local-cluster[3,2,3000]"])
def test_a_mounted_folder_is_used_on_a_cluster(spark, scratch, scheme, master):
    there = Elsewhere(spark, spark_master=master, spark_checkpoint_dir=f"{scheme}{scratch}/")
    assert storage.shared_folder(there) == storage.shared_folder(there) == f"{scheme}{scratch}"


def test_a_folder_with_a_remote_scheme_is_not_tried(spark):
    assert storage.shared_folder(Elsewhere(spark, spark_checkpoint_dir="s3a://bucket/x")) == "s3a://bucket/x"


def test_without_a_checkpoint_folder_a_cluster_uses_the_warehouse(spark, scratch):
    assert storage.shared_folder(Elsewhere(spark, spark_sql_warehouse_dir=scratch)) == scratch


def test_a_folder_where_rows_are_missing_is_refused(spark, scratch, monkeypatch):
    there = Elsewhere(spark, spark_checkpoint_dir=scratch)
    half = types.SimpleNamespace(schema=lambda _: types.SimpleNamespace(parquet=lambda path: spark.read.parquet(path).where("id > 0")))
    there.read = half
    with pytest.raises(RuntimeError, match="is not shared"):
        storage.shared_folder(there)


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_a_folder_that_cannot_be_written_is_passed_over(spark, scratch, scheme):
    with open(f"{scratch}/taken", "w"):
        pass
    there = Elsewhere(spark, spark_checkpoint_dir=f"{scheme}{scratch}/taken/shared", spark_sql_warehouse_dir=f"{scheme}{scratch}/tables/")
    assert storage.shared_folder(there) == storage.shared_folder(there) == f"{scheme}{scratch}/tables"


def test_the_session_s_checkpoint_folder_is_the_last_resort(spark, scratch):
    with open(f"{scratch}/taken", "w"):
        pass
    there = Elsewhere(spark, spark_checkpoint_dir=f"{scratch}/taken/a", spark_sql_warehouse_dir=f"{scratch}/taken/b")
    assert storage.shared_folder(there) == spark.sparkContext.getCheckpointDir().rstrip("/")


def test_a_temporary_folder_has_its_full_name(spark, scratch, monkeypatch):
    """A name that every process reads otherwise (/proc/self) is resolved by the driver."""
    own = {}
    alone = types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda k, *_: own.get(k, "local[2]" if k == "spark.master" else None), set=own.__setitem__))
    os.symlink(scratch, f"{scratch}-link")
    monkeypatch.setattr(storage.tempfile, "tempdir", f"{scratch}-link")
    assert storage.shared_folder(alone).startswith(f"{os.path.realpath(scratch)}/vehicle-metrics-")
