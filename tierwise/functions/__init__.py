"""Column helpers (all built-in Spark expressions)."""

from tierwise.functions.columns import (  # noqa: F401
    as_of_seconds,
    clean_status,
    clean_text,
    count_where,
    flag,
    hour_index,
    hours_between,
    month_key,
    pct,
    round_half_even,
    sum_where,
    ts_literal,
    ts_sql,
)
