"""Hard negatives against all scores, their SQL, and edge rows."""

import math
import os

import numpy as np
import pytest

from vehicle_metrics.llm import hard_negatives as H
from vehicle_metrics.llm.oracle import ORACLE_SQL

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    ok = []
    for i, x, label in rows:
        if i is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        q = [math.floor(256 * float(np.float32(c))) for c in x]
        ok.append((i, q, (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for a, (i, q, label) in enumerate(ok):
        if i % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(q, r)), j, b, other) for b, (j, r, other) in enumerate(ok) if b != a]
        for p, pid, _, _ in sorted(s for s in scored if s[3] == label)[:5]:
            p = -p
            found = sorted(s for s in scored if s[3] != label and 80 * p <= -100 * s[0] <= 100 * p)[:5]
            out += [(i, pid, rank, j, p, -s) for rank, (s, j, _, _) in enumerate(found, 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select(COLUMNS).collect())


def random_rows(rng, n, dim=20, step=0.25):
    x = np.round(rng.normal(size=(n, dim)) / step) * step * 0.2  # coarse, so scores tie
    return [(int(i), [float(c) for c in v], int(rng.integers(0, 4))) for i, v in enumerate(x)]


@pytest.mark.parametrize("blocks", [2_000, 2])
def test_equals_all_scores(spark, blocks, monkeypatch):
    monkeypatch.setattr(H, "ROW_BLOCK", 37)
    rows = random_rows(np.random.default_rng(1), 700)
    rows += [(1000 + i, rows[100][1], i % 3) for i in range(60)]  # copies of an anchor: many ties
    rows += [(100, rows[3][1], 1), (5, rows[5][1], rows[5][2])]  # repeated ids
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    mined = H.mine(H.materialize(H.vectors(df.selectExpr("vec_id", "embedding", "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label")),
                                 "test"), "id % 100 = 0", anchor_block=blocks)
    assert got(mined) == plain(rows)
    assert got(H.hard_negatives(df)) == plain(rows)


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(2)
    x, y = (np.floor(rng.normal(size=(50, 64)) * 100).astype(np.int64) for _ in range(2))
    exact, before = x @ y.T, None
    for a, b in zip(H.summaries(x), H.summaries(y)):
        low, high = H.bounds(a, b)
        assert (low <= exact).all() and (exact <= high).all()
        if before is not None:
            assert (high - low).mean() < before
        before = (high - low).mean()


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = random_rows(np.random.default_rng(5), 150, dim=6)
    rows += [(200, None, 1), (300, [1.0, None], 1), (400, [nan] * 6, 1), (500, [inf] * 6, 1), (600, rows[0][1], None), (None, rows[0][1], 1),
             (700, [], 2), (800, [0.5, 0.5], 0), (900, [300.0] * 6, 3), (901, [290.0] * 6, 2), (902, [310.0] * 6, 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(H.hard_negatives(df)) == plain(rows)
    assert got(H.hard_negatives(spark.createDataFrame([], SCHEMA))) == []
    assert got(H.hard_negatives(spark.createDataFrame([(1, [1.0], 1)], SCHEMA))) == []
    hollow = [(100, [], 1), (101, [], 1), (102, [], 2)]
    assert got(H.hard_negatives(spark.createDataFrame(hollow, SCHEMA))) == plain(hollow) != []


def test_query_equals_sql(spark):
    import duckdb

    import __spark_entry__ as E

    sf = "/root/testdata/sf0.01"
    if not os.path.isdir(sf):
        pytest.skip("test data not present")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    rel = con.sql(ORACLE_SQL["op12_hard_negatives"]).select(", ".join(COLUMNS))
    found = got(E.queries()["op12_hard_negatives"](spark, sf))
    assert found and found == sorted(rel.fetchall())
