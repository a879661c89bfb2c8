"""Queries that store tables, on a session taken for a cluster whose shared folder
has a name without a remote scheme: they end, with the rows of one process."""

import pytest

from fixtures import T
from vehicle_metrics import storage
from vehicle_metrics.plans.queries import QUERIES
from vehicle_metrics.sources import adapters

NAMES = [
    "csv_fuel",  # F3
    "csv_fuel_rejects",  # F4
    "driver_ranking",  # F5
    "incremental_daily",  # F6
    "published_alerts",  # F7
    "published_daily_telemetry",  # F8
    "published_driver_ranking",  # F9
    "published_fleet_summary",  # F10
    "published_kpi_master",  # F11
    "report_cost",  # F12
    "report_performance",  # F13
    "round_trip_daily_telemetry",  # F14
    "telemetry_counts",  # F15
]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Events of three vehicles on both sides of incremental_daily's border, fuel
    fills with every fault of ``fuel_files``, orders of two of the vehicles."""
    root = str(tmp_path_factory.mktemp("tables"))
    kinds = ["view", "error", "purchase", "click"]
    rows = {
        "events": [(i, T(2024, 1, 14 + i % 4, i % 24), i % 3, kinds[i % 4], 40.0 + 3 * (i % 50), '{"k": %d}' % (i % 9)) for i in range(120)],
        "lineitem": [(i, i % 3, 1 + i % 2, 10.0 + i, 9000.0 + 100 * i, 0.05, T(2024, 1, 1 + i % 28)) for i in range(120)],
        "orders": [(i, i % 2, 5000.0 + i, T(2024, 1, 1 + i), ["1-URGENT", "5-LOW"][i % 2]) for i in range(20)],
    }
    for name, found in rows.items():
        spark.createDataFrame(found, adapters.BENCH_SCHEMAS[name]).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.mark.parametrize("name", NAMES)
def test_a_query_that_stores_tables_ends_on_a_cluster(spark, tables, name, monkeypatch):
    def rows():
        return sorted(map(str, QUERIES[name](spark, tables).collect()))

    alone = rows()
    monkeypatch.setattr(storage, "_is_local", lambda _: False)
    assert alone and rows() == alone
