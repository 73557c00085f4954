"""Column -> Column helpers. All are built-in Spark expressions (JVM side, whole-stage codegen);
no Python runs per row."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_index(ts: ColumnOrName) -> Column:
    """Number of hour boundaries between 1970-01-01 00:00 (wall clock) and ``ts``.

    Differences of this index count hour *boundaries crossed* (10:59 -> 11:01 is 1 hour), which is
    what the warehouse's ``dateDiff('hour', a, b)`` means; Spark's ``timestampdiff(HOUR)`` counts
    elapsed hours instead. Computed from the wall-clock date and hour so it is identical for
    ``timestamp_ntz`` and for zoned timestamps read in the session time zone.
    """
    t = _col(ts)
    days = F.datediff(F.to_date(t), F.lit(_dt.date(1970, 1, 1))).cast("bigint")
    return days * F.lit(24) + F.hour(t).cast("bigint")


def hours_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Hour boundaries crossed from ``start`` to ``end`` (negative when reversed), bigint."""
    return (hour_index(end) - hour_index(start)).cast("bigint")


def round_half_even(x: ColumnOrName, scale: int = 2) -> Column:
    """Round a double to ``scale`` decimals, ties to even (``3.125 -> 3.12``).

    Spark's ``round`` rounds half up; ``rint`` is IEEE round-half-even, so
    ``rint(x * 10^scale) / 10^scale`` reproduces the warehouse's float rounding."""
    f = float(10**scale)
    return F.rint(_col(x).cast("double") * F.lit(f)) / F.lit(f)


def pct(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """``(part / whole) * 100`` as double, NULL when ``whole`` is 0 (no ANSI division error)."""
    return F.try_divide(_col(part).cast("double"), _col(whole).cast("double")) * F.lit(100.0)


def month_key(ts: ColumnOrName) -> Column:
    """Calendar month ``yyyymm`` as int (NULL timestamp -> NULL month)."""
    t = _col(ts)
    return (F.year(t) * F.lit(100) + F.month(t)).cast("int")


def clean_text(s: ColumnOrName) -> Column:
    """Strip leading/trailing spaces only (tabs and newlines stay), like SQL ``trim``."""
    return F.trim(_col(s))


def clean_status(s: ColumnOrName) -> Column:
    """``upper(trim(status))``."""
    return F.upper(F.trim(_col(s)))


def flag(cond: Column) -> Column:
    """Boolean condition -> int 0/1 (never NULL: a NULL condition gives 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("int")


def count_where(cond: Column) -> Column:
    """``countIf``: rows where ``cond`` is true, bigint (0 when none)."""
    return F.count_if(cond).cast("bigint")


def sum_where(x: ColumnOrName, cond: Column) -> Column:
    """``sumIf``: sum of ``x`` where ``cond``; 0 (not NULL) when nothing matches."""
    return F.coalesce(F.sum(F.when(cond, _col(x))), F.lit(0)).cast("bigint")


def ts_sql(value: str | int | _dt.datetime | None, data_type: T.DataType | None = None) -> str:
    """SQL text of a timestamp literal of the given Spark type (default ``timestamp_ntz``).

    Text is read as wall-clock time (zone-free for NTZ, session zone for zoned timestamps); an
    ``int`` (or a string of digits) is an instant in epoch microseconds, exact for zoned timestamps
    even in a DST overlap."""
    dt = data_type or T.TimestampNTZType()
    type_sql = "TIMESTAMP_NTZ" if isinstance(dt, T.TimestampNTZType) else "TIMESTAMP"
    if value is None:
        return f"CAST(NULL AS {type_sql})"
    if isinstance(value, int) or (isinstance(value, str) and value.lstrip("-").isdigit()):
        return f"CAST(timestamp_micros({int(value)}) AS {type_sql})"
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    text = str(value)
    if not all(ch.isdigit() or ch in " -:.T" for ch in text):
        raise ValueError(f"not a timestamp literal: {text!r}")
    return f"CAST('{text}' AS {type_sql})"


def ts_literal(value: str | int | _dt.datetime | None, data_type: T.DataType | None = None) -> Column:
    """Timestamp literal Column (see ``ts_sql``); the optimizer folds it to a constant, so a
    comparison with it is pushed into Parquet/JDBC scans."""
    return F.expr(ts_sql(value, data_type))


def as_of_seconds(as_of: str | _dt.datetime) -> str:
    """Run time as text truncated to whole seconds (``load_at``/``processed_at`` are seconds)."""
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    return as_of.replace(microsecond=0).isoformat(sep=" ")
