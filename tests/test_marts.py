"""Silver cleansing and the five marts on hand-written rows (FIXTURES.md §6)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import src_df
from tierwise.operators import gold, load
from tierwise.operators.silver import silver_cleansed

AS_OF = "2025-01-02 00:00:00"


def silver_of(spark, rows):
    return silver_cleansed(load.bronze_projection(src_df(spark, rows), AS_OF))


def test_silver_cleans_status_and_flags_deletes(spark):
    s = silver_of(
        spark,
        [
            (" A ", " c ", " delivered ", " X ", "Y ", "2025-01-01 00:00:00", "2025-01-01 01:00:00", "2025-01-01 01:00:00"),
            ("B", "c", "\tbooked", "X", "Y", "2025-01-01 00:00:00", "2025-01-01 01:00:00", None),
        ],
    ).orderBy("id").collect()
    assert (s[0]["id"], s[0]["customer_id"], s[0]["last_status"], s[0]["pos_origin"], s[0]["pos_destination"]) == (
        "A", "c", "DELIVERED", "X", "Y")
    assert s[0]["is_deleted"] == 1 and s[1]["is_deleted"] == 0
    assert s[1]["last_status"] == "\tBOOKED"  # tabs are not trimmed


def test_soft_delete_after_delivery(spark):
    rows = [
        ("A", "c", "DELIVERED", "X", "Y", "2025-01-01 00:00:00", "2025-01-01 05:00:00", "2025-01-01 05:00:00"),
        ("B", "c", "DELIVERED", "X", "Y", "2025-01-01 00:00:00", "2025-01-01 02:30:00", None),
    ]
    s = silver_of(spark, rows)
    m1 = gold.gold_daily_transaction_valid(s, AS_OF).collect()
    m2 = gold.gold_daily_transaction_comprehensive(s, AS_OF).collect()
    m3 = gold.gold_route_performance_metrics(s, AS_OF).collect()
    m5 = gold.gold_delivery_success_rate(s, AS_OF).collect()
    assert [r["total_valid_transactions"] for r in m1] == [1]
    assert [(r["total_transactions"], r["total_soft_deleted"]) for r in m2] == [(2, 1)]
    assert [(r["total_delivered_packages"], r["fastest_delivery_hours"], r["slowest_delivery_hours"]) for r in m3] == [(1, 2, 2)]
    assert [(r["total_packages"], r["total_delivered"], r["success_rate_pct"]) for r in m5] == [(1, 1, 100.0)]
    assert m1[0]["processed_at"] == dt.datetime(2025, 1, 2)


def test_aging_counts_hour_boundaries_and_empty_is_healthy(spark):
    rows = [
        # 11:59 before as_of at 00:00 -> 12 boundaries (11:59 elapsed): stuck
        ("A", "c", "IN_TRANSIT", "X", "Y", "2025-01-01 00:00:00", "2025-01-01 12:01:00", None),
        ("B", "c", "IN_TRANSIT", "X", "Y", "2025-01-01 00:00:00", "2025-01-01 12:30:00", None),
        ("C", "c", "DELIVERED", "X", "Y", "2025-01-01 00:00:00", "2025-01-01 00:00:00", None),
        ("D", "c", "IN_TRANSIT", "X", "Y", "2025-01-01 00:00:00", "2025-01-01 13:00:00", None),  # 11 h
    ]
    m4 = gold.gold_aging_bottleneck_alerts(silver_of(spark, rows), AS_OF).collect()
    assert [(r["last_status"], r["total_stuck_packages"], r["max_hours_stuck"]) for r in m4] == [("IN_TRANSIT", 2, 12)]
    healthy = silver_of(spark, [rows[2], rows[3]])
    assert gold.gold_aging_bottleneck_alerts(healthy, AS_OF).count() == 0


def test_null_city_and_null_status(spark):
    rows = [
        ("A", "c", None, None, "Y", "2025-01-01 00:00:00", "2025-01-01 00:00:00", None),
        ("B", "c", "BOOKED", None, "Y", "2025-01-01 00:00:00", "2025-01-01 00:00:00", None),
    ]
    s = silver_of(spark, rows)
    m1 = gold.gold_daily_transaction_valid(s, AS_OF).collect()
    m2 = gold.gold_daily_transaction_comprehensive(s, AS_OF).collect()
    m4 = gold.gold_aging_bottleneck_alerts(s, AS_OF).collect()
    m5 = gold.gold_delivery_success_rate(s, AS_OF).collect()
    assert [r["last_status"] for r in m1] == ["BOOKED"]  # NULL != 'CANCELLED' is not true
    assert sorted((r["last_status"] or "") for r in m2) == ["", "BOOKED"]
    assert [r["last_status"] for r in m4] == ["BOOKED"]
    assert [(r["pos_origin"], r["total_packages"]) for r in m5] == [(None, 2)]  # one NULL-city group


def test_success_rate_rounds_half_even(spark):
    rows = [("D", "c", "DELIVERED", "X", "Y", "2025-01-01 00:00:00", "2025-01-01 00:00:00", None)]
    rows += [(f"B{i}", "c", "BOOKED", "X", "Y", "2025-01-01 00:00:00", "2025-01-01 00:00:00", None) for i in range(31)]
    m5 = gold.gold_delivery_success_rate(silver_of(spark, rows), AS_OF).first()
    assert m5["success_rate_pct"] == pytest.approx(3.12)


def test_single_scan_cube_equals_direct_marts(spark):
    from tierwise.plans import scenarios as sc
    from tierwise.sources.fixtures import AS_OF as FX_AS_OF

    for silver in (sc.clean_silver(spark, "/root/testdata/sf0.001"), sc.dirty_silver(spark, "/root/testdata/sf0.001")):
        marts = gold.marts_from_cube(gold.mart_cube(silver, FX_AS_OF), FX_AS_OF)
        for name, fn in gold.MARTS.items():
            direct = fn(silver, FX_AS_OF)
            cube = marts[name].select(*direct.columns)
            types = lambda d: [(f.name, f.dataType.simpleString()) for f in d.schema.fields]
            assert types(cube) == types(direct), name
            assert cube.exceptAll(direct).count() == 0 and direct.exceptAll(cube).count() == 0, name


def test_read_order_is_total(spark):
    rows = [("A", "c", "BOOKED", "X", "Y", "2025-01-01 00:00:00", "2025-01-01 00:00:00", None)]
    m5 = gold.in_read_order(gold.gold_delivery_success_rate(silver_of(spark, rows), AS_OF), "gold_delivery_success_rate")
    assert m5.count() == 1
    assert [c for c in m5.columns if c.startswith("total")] == ["total_packages", "total_delivered", "total_cancelled"]
    assert m5.filter(F.col("total_packages") > 0).count() == 1


def test_read_order_of_aging_mart(spark):
    """O1: count desc, then average desc, then the grain as a total tiebreak."""
    from tierwise.plans import scenarios as sc
    from tierwise.sources.fixtures import AS_OF as FX_AS_OF

    m4 = gold.gold_aging_bottleneck_alerts(sc.clean_silver(spark, "/root/testdata/sf0.001"), FX_AS_OF)
    rows = gold.in_read_order(m4, "gold_aging_bottleneck_alerts").collect()
    keys = [
        (-r["total_stuck_packages"], -r["avg_hours_stuck"], r["last_status"] or "", r["pos_origin"] or "", r["pos_destination"] or "")
        for r in rows
    ]
    assert len(rows) > 1 and keys == sorted(keys)
