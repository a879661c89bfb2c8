"""Every registered fleet query against its DuckDB oracle at sf0.001, plus the
driver contract (entry smoke, keys of queries() and oracle_sql()). The optional
training-text queries have their tests in ``tests/llm``."""

import math
import os

import pytest

import __spark_entry__ as E
from vehicle_metrics.oracle import ORACLE_SQL
from vehicle_metrics.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(records):
    return sorted((tuple(_norm(x) for x in r) for r in records), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck(spark):
    import duckdb

    con = duckdb.connect()
    for t in ["nation", "customer", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_contract_keys():
    assert set(QUERIES) == set(ORACLE_SQL) and len(QUERIES) >= 30
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "priority_rank" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = _rows([[r[c] for c in cols] for r in df.collect()])
    rel = duck.sql(ORACLE_SQL[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    exp = _rows([[r[i] for i in idx] for r in rel.fetchall()])
    assert got == exp
