"""Exact global RANK() without funnelling every row through one task.

``rank() OVER (ORDER BY x)`` with no PARTITION BY makes Spark move the
whole input into a single partition. Here a row's rank is
``1 + (number of rows ordered strictly before its value)``:

1. the rows are written once to the shared folder (the branches below read
   the same stored values, so equal values stay equal to the last bit);
2. they are pre-aggregated to (value, count), and the values are dealt by
   range to buckets of at most about ``values_per_bucket`` values, stored;
3. a running count inside each bucket plus the counts of the buckets before
   it gives the rows before each value;
4. the ranks are joined back. Values that hold at least one row in
   ``HEAVY_SHARE`` (so at most HEAVY_SHARE values) are joined by broadcast,
   all others by a shuffle in which no value has many rows.

A column that by its definition has few values (a sum of a few weights) needs
no buckets: ``rank_few_values`` broadcasts its counts.

NULLs are a value like any other, first or last as in Spark's order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vehicle_metrics.functions.exprs import q
from vehicle_metrics.storage import materialize

_V, _N, _B, _R = "_rank_value", "_rank_rows", "_rank_bucket", "_rank"
HEAVY_SHARE = 1000


def _before(ascending: bool, partition: str | None) -> str:
    """The number of rows with a value ordered before, within ``partition``."""
    by = f"PARTITION BY {partition} " if partition else ""
    order = f"{_V} ASC NULLS FIRST" if ascending else f"{_V} DESC NULLS LAST"
    return (f"coalesce(sum({_N}) OVER ({by}ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
            "AS _before")


def rank_few_values(df: DataFrame, order_col: str, rank_col: str, ascending: bool = True) -> DataFrame:
    """``global_rank`` for a column with a handful of values by definition:
    the counts are one row for each value, summed in one window and broadcast."""
    x = q(order_col)
    rows = materialize(df, "rank_rows")
    counts = rows.groupBy(F.expr(f"{x} AS {_V}")).agg(F.expr(f"count(1) AS {_N}"))
    ranks = counts.selectExpr(_V, _before(ascending, None)).selectExpr(_V, f"CAST(1 + _before AS INT) AS {_R}")
    out = [*[q(c) for c in df.columns], f"{_R} AS {q(rank_col)}"]
    return rows.join(F.broadcast(ranks), F.expr(f"{x} <=> {_V}")).selectExpr(*out)


def global_rank(df: DataFrame, order_col: str, rank_col: str, ascending: bool = True,
                values_per_bucket: int = 1_000_000) -> DataFrame:
    """Add ``rank_col`` = RANK() OVER (ORDER BY order_col [ASC|DESC])."""
    x = q(order_col)
    rows = materialize(df, "rank_rows")
    total = rows.count()  # from the file footers
    order = F.col(_V).asc_nulls_first() if ascending else F.col(_V).desc_nulls_last()
    n_buckets = max(1, -(-total // values_per_bucket))  # there are no more values than rows
    values = rows.groupBy(F.expr(f"{x} AS {_V}")).agg(F.expr(f"count(1) AS {_N}"))
    dealt = materialize(values.repartitionByRange(n_buckets, order).withColumn(_B, F.spark_partition_id()), "rank_buckets")
    # One row for each bucket: a global window here is over buckets, not rows.
    offsets = dealt.groupBy(_B).agg(F.expr(f"sum({_N}) AS _bucket_rows")).selectExpr(
        _B, f"coalesce(sum(_bucket_rows) OVER (ORDER BY {_B} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
            "AS _offset")
    ranks = dealt.selectExpr("*", _before(ascending, _B)).join(offsets, _B).selectExpr(
        _V, _N, f"CAST(1 + _offset + _before AS INT) AS {_R}")

    heavy_rows = max(1, -(-total // HEAVY_SHARE))
    heavy, light = ranks.where(f"{_N} >= {heavy_rows}").drop(_N), ranks.where(f"{_N} < {heavy_rows}").drop(_N)
    same = F.expr(f"{x} <=> {_V}")
    out = [*[q(c) for c in df.columns], f"{_R} AS {q(rank_col)}"]
    common = rows.join(F.broadcast(heavy), same).selectExpr(*out)
    rare = rows.join(F.broadcast(heavy.select(_V)), same, "left_anti").join(light, same).selectExpr(*out)
    return common.unionByName(rare)
