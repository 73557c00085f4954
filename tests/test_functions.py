import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.functions import (
    clean_status,
    clean_text,
    hours_between,
    month_key,
    pct,
    round_half_even,
    ts_literal,
)


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "a,b,expected",
    [
        ("2025-01-01 10:59:00", "2025-01-01 11:01:00", 1),  # a boundary, not an elapsed hour
        ("2025-01-01 11:00:00", "2025-01-01 11:59:59", 0),
        ("2025-01-01 23:30:00", "2025-01-02 00:10:00", 1),  # across midnight
        ("1969-12-31 22:15:00", "1970-01-01 01:05:00", 3),  # before the epoch
        ("2025-01-01 11:01:00", "2025-01-01 10:59:00", -1),  # reversed
        ("2024-02-28 12:00:00", "2024-03-01 12:00:00", 48),  # leap day
    ],
)
def test_hours_between_counts_boundaries(spark, a, b, expected):
    assert one(spark, hours_between(ts_literal(a), ts_literal(b))) == expected


def test_hours_between_type_is_bigint(spark):
    df = spark.range(1).select(hours_between(ts_literal("2025-01-01 00:00:00"), ts_literal("2025-01-02 00:00:00")).alias("h"))
    assert df.schema["h"].dataType == T.LongType()


@pytest.mark.parametrize("x,expected", [(3.125, 3.12), (3.135, 3.14), (2.5, 2.5), (-3.125, -3.12), (0.005, 0.0)])
def test_round_half_even(spark, x, expected):
    assert one(spark, round_half_even(F.lit(x), 2)) == pytest.approx(expected)


def test_one_of_32_is_3_12(spark):
    assert one(spark, round_half_even(pct(F.lit(1), F.lit(32)), 2)) == pytest.approx(3.12)


def test_pct_zero_denominator_is_null(spark):
    assert one(spark, pct(F.lit(1), F.lit(0))) is None


def test_month_key(spark):
    assert one(spark, month_key(ts_literal("2001-09-01 00:17:00"))) == 200109
    assert one(spark, month_key(F.lit(None).cast("timestamp_ntz"))) is None


def test_trim_is_spaces_only(spark):
    assert one(spark, clean_text(F.lit("  a b  "))) == "a b"
    assert one(spark, clean_text(F.lit("\ta\n"))) == "\ta\n"
    assert one(spark, clean_status(F.lit(" delivered "))) == "DELIVERED"
    assert one(spark, clean_status(F.lit("\tdelivered"))) == "\tDELIVERED"


def test_ts_literal_round_trip_keeps_microseconds(spark):
    v = one(spark, ts_literal("2001-08-31 23:59:59.123456"))
    assert v == dt.datetime(2001, 8, 31, 23, 59, 59, 123456)


def test_zoned_source_cuts_days_in_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
        d = spark.range(1).select(F.to_date(F.to_timestamp(F.lit("2025-01-01T18:30:00Z"))).alias("d")).first()["d"]
        assert d == dt.date(2025, 1, 2)
        d2 = spark.range(1).select(F.to_date(ts_literal("2025-01-01 18:30:00")).alias("d")).first()["d"]
        assert d2 == dt.date(2025, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
