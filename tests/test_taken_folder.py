"""Queries that store tables, in one process whose checkpoint folder has another
user's ``vehicle_metrics`` in it: they end, with the rows of any other folder."""

import pytest

from test_cluster_queries import tables  # noqa: F401
from vehicle_metrics.plans.queries import QUERIES

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


@pytest.mark.parametrize("name", NAMES)
def test_a_query_that_stores_tables_ends_beside_a_taken_folder(spark, tables, name, scratch, monkeypatch):  # noqa: F811
    def rows():
        return sorted(map(str, QUERIES[name](spark, tables).collect()))

    elsewhere = rows()
    with open(f"{scratch}/vehicle_metrics", "w"):  # root may write to any user's folder, but not below a file
        pass
    conf = type(spark.conf)
    monkeypatch.setattr(conf, "get", lambda self, key, *other, get=conf.get: scratch if key == "spark.checkpoint.dir" else get(self, key, *other))
    assert elsewhere and rows() == elsewhere
