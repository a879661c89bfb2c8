"""Expressions shared by the operators (all JVM-side built-ins): SQL-text
builders for projections and a few Column helpers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Severity names and their report order.
SEVERITY_ORDER = ["CRITICAL", "HIGH", "MEDIUM"]  # anything else sorts last


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (never an ANSI error)."""
    return F.try_divide(_col(num), _col(den))


def as_date(value) -> Column:
    """An as-of date: None -> current_date(), str/date -> literal, Column as is."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.date()
    return F.lit(str(value)).cast("date")


# -- SQL-text forms ------------------------------------------------------------
# Each DataFrame-API call is a round trip to the JVM; a projection written as
# SQL text is parsed there in one call, which keeps plan construction cheap
# for wide projections and rule lists.

def q(name: str) -> str:
    """Backtick-quote a column name."""
    return "`" + name.replace("`", "``") + "`"


def sql_double(v: float) -> str:
    """A DOUBLE literal (a bare 7.0 would be a DECIMAL in Spark SQL)."""
    return f"{float(v)!r}D"


def sql_str(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ratio_sql(num: str, den: str) -> str:
    return f"try_divide({num}, {den})"


def per_100km_sql(events: str, distance: str, scale: int = 2) -> str:
    return f"round(try_divide({events}, {distance}) * 100, {scale})"


def flag_sql(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def date_sql(value) -> str:
    """An as-of date as SQL: None -> current_date(), else a DATE literal."""
    if value is None:
        return "current_date()"
    if isinstance(value, _dt.datetime):
        value = value.date()
    return f"DATE{sql_str(str(value))}"


def timestamp_sql(value) -> str:
    """An as-of timestamp as SQL of type TIMESTAMP_NTZ: the session's wall
    clock for None, else a literal (independent of the session time zone)."""
    if value is None:
        return "CAST(current_timestamp() AS TIMESTAMP_NTZ)"
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return f"CAST({sql_str(str(value))} AS TIMESTAMP_NTZ)"


SEVERITY_LEVEL_SQL = (
    "CASE " + " ".join(f"WHEN severity = '{name}' THEN {i}" for i, name in enumerate(SEVERITY_ORDER))
    + f" ELSE {len(SEVERITY_ORDER)} END"
)


def round_doubles(df: DataFrame, scale: int = 6) -> DataFrame:
    """Round every double column to ``scale`` places.

    Floating-point sums depend on the order rows are added in, which varies
    with partitioning; rounding published doubles makes outputs stable
    across plans, retries and engines. The value is first snapped to
    ``scale + 3`` places, so last-bit noise cannot move a value that lies
    exactly on a rounding boundary (e.g. a mean of 46.6246875) either way.
    """
    return df.selectExpr(*[
        f"round(round({q(f.name)}, {scale + 3}), {scale}) AS {q(f.name)}"
        if isinstance(f.dataType, DoubleType) else q(f.name)
        for f in df.schema.fields
    ])
