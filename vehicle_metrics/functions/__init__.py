from vehicle_metrics.functions.exprs import (
    SEVERITY_LEVEL_SQL,
    as_date,
    date_sql,
    flag_sql,
    per_100km_sql,
    q,
    ratio_sql,
    round_doubles,
    safe_ratio,
    sql_double,
    sql_str,
    timestamp_sql,
)

__all__ = [
    "SEVERITY_LEVEL_SQL",
    "as_date",
    "date_sql",
    "flag_sql",
    "per_100km_sql",
    "q",
    "ratio_sql",
    "round_doubles",
    "safe_ratio",
    "sql_double",
    "sql_str",
    "timestamp_sql",
]
