"""Checks of written output tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vehicle_metrics.functions.exprs import q, sql_str

#: The key of each curated output.
OUTPUT_KEYS = {"kpi_master": "vehicle_id", "alerts": "alert_id", "driver_ranking": "driver_id"}


def validate_outputs(tables: Mapping[str, DataFrame], keys: Mapping[str, str] = OUTPUT_KEYS) -> DataFrame:
    """(table_name, row_count, null_keys, repeated_keys, passed), one row for
    each table: it passes if it has rows and its key is unique and not NULL.
    Rows are counted per key first, in partial aggregates."""
    def one(name: str) -> DataFrame:
        key = q(keys[name])
        per_key = tables[name].groupBy(F.expr(f"{key} AS _key")).agg(F.expr("count(1) AS _n"))
        return per_key.agg(
            F.expr("coalesce(sum(_n), 0) AS row_count"),
            F.expr("coalesce(sum(CASE WHEN _key IS NULL THEN _n ELSE 0 END), 0) AS null_keys"),
            F.expr("count_if(_key IS NOT NULL AND _n > 1) AS repeated_keys"),
        ).selectExpr(f"{sql_str(name)} AS table_name", "row_count", "null_keys", "repeated_keys",
                     "row_count > 0 AND null_keys = 0 AND repeated_keys = 0 AS passed")

    return reduce(DataFrame.unionByName, [one(n) for n in tables if n in keys])
