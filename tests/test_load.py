"""Watermark, incremental window, gate, upsert and version dedup on hand-written rows."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import src_df
from tierwise.operators import load

T0 = "2025-01-01 10:00:00"


def rows_by_id(df):
    return {r["id"]: r for r in df.collect()}


def test_empty_bronze_watermark_is_none_and_full_load(spark):
    src = src_df(spark, [("A", "c", "BOOKED", "X", "Y", T0, T0, None)])
    empty = load.bronze_projection(src, T0).limit(0)
    assert load.watermark(empty) is None
    assert load.watermark(None) is None
    assert load.incremental_filter(src, None).count() == 1  # not `>= NULL`, which drops everything
    assert load.has_new_rows(src, None) is True


def test_gate_true_when_bronze_missing_or_forced(spark):
    src = src_df(spark, [("A", "c", "BOOKED", "X", "Y", T0, T0, None)])
    assert load.has_new_rows(src, "2030-01-01 00:00:00", bronze_exists=False) is True
    assert load.has_new_rows(src, "2030-01-01 00:00:00", force=True) is True


def test_nothing_newer_gate_false_but_load_rereads_boundary(spark):
    src = src_df(spark, [("A", "c", "BOOKED", "X", "Y", T0, T0, None), ("B", "c", "BOOKED", "X", "Y", T0, "2025-01-01 09:00:00", None)])
    wm = "2025-01-01 10:00:00"
    assert load.has_new_rows(src, wm) is False  # strict >
    batch = load.incremental_filter(src, wm)  # inclusive >=
    assert [r["id"] for r in batch.collect()] == ["A"]
    assert load.new_data_gate_df(src, wm).first()["has_new_rows"] == 0


def test_same_microsecond_as_watermark_is_loaded(spark):
    t = "2025-01-01 10:00:00.123456"
    src = src_df(spark, [("late", "c", "BOOKED", "X", "Y", T0, t, None)])
    assert load.incremental_filter(src, t).count() == 1


def test_null_updated_at_becomes_epoch_and_never_enters_incremental(spark):
    src = src_df(spark, [("N", "c", "BOOKED", "X", "Y", T0, None, None)])
    b = load.bronze_projection(src, "2025-01-02 00:00:00")
    assert b.first()["updatedAt"] == dt.datetime(1970, 1, 1)
    assert load.incremental_filter(b, "2025-01-01 00:00:00").count() == 0


def test_late_row_below_watermark_not_loaded(spark):
    src = src_df(spark, [("old", "c", "BOOKED", "X", "Y", T0, "2024-12-31 23:00:00", None)])
    assert load.incremental_filter(src, "2025-01-01 00:00:00").count() == 0


def test_watermark_filter_is_pushed_into_parquet_scan(spark, scratch):
    src = src_df(spark, [("A", "c", "BOOKED", "X", "Y", T0, T0, None)])
    src.write.parquet(f"{scratch}/src")
    batch = load.incremental_filter(spark.read.parquet(f"{scratch}/src"), "2025-01-01 00:00:00")
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(updatedAt), GreaterThanOrEqual(updatedAt" in plan


def test_upsert_batch_wins_and_keeps_soft_deleted(spark):
    old = load.bronze_projection(
        src_df(spark, [("A", "c", "DELIVERED", "X", "Y", T0, T0, None), ("B", "c", "BOOKED", "X", "Y", T0, T0, None)]),
        "2025-01-01 11:00:00",
    )
    batch = load.bronze_projection(
        src_df(spark, [("A", "c", "DELIVERED", "X", "Y", T0, "2025-01-01 12:00:00", "2025-01-01 12:00:00")]),
        "2025-01-01 13:00:00",
    )
    out = rows_by_id(load.upsert_by_key(old, batch))
    assert set(out) == {"A", "B"}
    assert out["A"]["deletedAt"] == dt.datetime(2025, 1, 1, 12)
    assert out["A"]["load_at"] == dt.datetime(2025, 1, 1, 13)


def test_rerunning_the_same_batch_is_idempotent(spark):
    src = src_df(spark, [("A", "c", "BOOKED", "X", "Y", T0, T0, None), ("B", "c", "BOOKED", "X", "Y", T0, T0, None)])
    b1, _, _ = load.apply_load(None, src, "2025-01-02 00:00:00")
    b2, batch, wm = load.apply_load(b1, src, "2025-01-02 00:00:00")
    assert wm == "2025-01-01 10:00:00"
    assert batch.count() == 2  # the boundary rows are re-read ...
    assert sorted(map(tuple, b2.collect())) == sorted(map(tuple, b1.collect()))  # ... and change nothing


def test_versioned_dedup_two_statuses_same_day_both_kept(spark):
    rows = [
        ("A", "c", "BOOKED", "X", "Y", T0, "2025-01-01 10:00:00", None),
        ("A", "c", "PROCESSING", "X", "Y", T0, "2025-01-01 11:00:00", None),
    ]
    b = load.bronze_projection(src_df(spark, rows), "2025-01-02 00:00:00")
    assert load.dedup_versions(b, load.bronze_sort_key()).count() == 2
    assert load.upsert_by_key(b.limit(0), b.filter(F.col("lastStatus") == "PROCESSING")).count() == 1


def test_versioned_dedup_same_status_same_day_keeps_greatest_version(spark):
    rows = [
        ("A", "c1", "BOOKED", "X", "Y", T0, "2025-01-01 10:00:00", None),
        ("A", "c2", "BOOKED", "X", "Y", T0, "2025-01-01 15:00:00", None),
        ("A", "c3", "BOOKED", "X", "Y", T0, "2025-01-02 09:00:00", None),  # another day: kept apart
    ]
    b = load.bronze_projection(src_df(spark, rows), "2025-01-03 00:00:00")
    out = load.dedup_versions(b, load.bronze_sort_key()).orderBy("updatedAt").collect()
    assert [r["customerId"] for r in out] == ["c2", "c3"]


def test_versioned_dedup_tie_goes_to_latest_arrival(spark):
    a = load.bronze_projection(src_df(spark, [("A", "old", "BOOKED", "X", "Y", T0, T0, None)]), "2025-01-01 11:00:00")
    b = load.bronze_projection(src_df(spark, [("A", "new", "BOOKED", "X", "Y", T0, T0, None)]), "2025-01-01 12:00:00")
    out = load.dedup_versions(a.unionByName(b), load.bronze_sort_key()).collect()
    assert [r["customerId"] for r in out] == ["new"]


def test_latest_per_key_with_a_hot_key_matches_brute_force(spark):
    # one key holds a third of all rows
    data = [("hot", i, f"v{i}") for i in range(3000)] + [(f"k{i % 2000}", i, f"v{i}") for i in range(6000)]
    df = spark.createDataFrame(data, "key string, ver int, payload string").repartition(8)
    got = {r["key"]: (r["ver"], r["payload"]) for r in load.latest_per_key(df, ["key"], ["ver"]).collect()}
    expect = {}
    for k, v, p in data:
        if k not in expect or v > expect[k][0]:
            expect[k] = (v, p)
    assert got == expect


def test_month_retention(spark):
    rows = [
        ("A", "c", "BOOKED", "X", "Y", "2024-12-31 23:00:00", T0, None),
        ("B", "c", "BOOKED", "X", "Y", "2025-01-01 00:00:00", T0, None),
        ("C", "c", "BOOKED", "X", "Y", None, T0, None),
    ]
    b = load.with_partition_column(load.bronze_projection(src_df(spark, rows), T0))
    assert sorted(r["id"] for r in load.retain_from_month(b, 202501).collect()) == ["B", "C"]
    assert sorted(r["id"] for r in load.drop_months(b, [202412]).collect()) == ["B", "C"]


def test_zoned_watermark_is_exact_in_a_dst_overlap(spark):
    """Zoned source in a DST zone: the watermark is an instant, so the fall-back hour cannot move it."""
    from pyspark.sql import types as T

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        # 2024-11-03 01:30 EDT (05:30Z) and 01:10 EST (06:10Z): the later instant has the earlier wall clock
        df = spark.createDataFrame([("A", 1730611800), ("B", 1730614200)], "id string, s long").select(
            "id", F.timestamp_seconds("s").alias("updatedAt")
        )
        assert df.schema["updatedAt"].dataType == T.TimestampType()
        wm = load.watermark(df)
        assert wm == str(1730614200 * 1_000_000)
        assert [r["id"] for r in load.incremental_filter(df, wm).collect()] == ["B"]
        assert load.has_new_rows(df, wm) is False
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_read_source_conforms_schema_and_rejects_missing_columns(spark, scratch):
    import pytest as _pytest

    from tierwise.sources.source import read_source

    rows = [("A", "c", "BOOKED", "X", "Y", T0, T0, None)]
    src_df(spark, rows).select("deletedAt", "id", "lastStatus", "customerId", "posOrigin", "posDestination", "createdAt", "updatedAt", F.lit(1).alias("extra")).write.parquet(f"{scratch}/src")
    df = read_source(spark, f"{scratch}/src")
    assert df.columns == ["id", "customerId", "lastStatus", "posOrigin", "posDestination", "createdAt", "updatedAt", "deletedAt"]
    assert df.count() == 1
    src_df(spark, rows).drop("posOrigin").write.parquet(f"{scratch}/bad")
    with _pytest.raises(ValueError):
        read_source(spark, f"{scratch}/bad")


def test_read_source_refuses_other_types_and_one_task_jdbc(spark, scratch):
    import pytest as _pytest

    from tierwise.sources.source import read_source

    rows = [("A", "c", "BOOKED", "X", "Y", T0, T0, None)]
    src_df(spark, rows).withColumn("id", F.lit(5)).write.parquet(f"{scratch}/typed")
    with _pytest.raises(ValueError, match="id is int"):
        read_source(spark, f"{scratch}/typed")
    with _pytest.raises(ValueError, match="partitionColumn"):
        read_source(spark, "jdbc:x://host/db", fmt="jdbc", jdbc_options={"dbtable": "t"})


def test_replay_invariant_after_every_load(spark):
    """After each incremental load, Bronze equals the source snapshot at that cut (load_at aside)."""
    from conftest import SF_SMALL
    from tierwise.plans import scenarios as sc
    from tierwise.sources import fixtures as fx

    rep = sc.replay(spark, SF_SMALL)
    changes = fx.retail_transaction_changes(spark, SF_SMALL)
    for state, cut in zip(rep.states, fx.REPLAY_CUTS):
        snap = fx.snapshot_at(changes, cut)
        got = state.drop("load_at")
        assert got.count() == snap.count() == got.select("id").distinct().count(), cut
        assert got.exceptAll(snap).count() == 0 and snap.exceptAll(got).count() == 0, cut


def test_empty_bronze_dataframe_forms(spark):
    """D3 as DataFrames: an empty Bronze has a NULL watermark row, and the gate says 1."""
    src = src_df(spark, [("A", "c", "BOOKED", "X", "Y", T0, T0, None)])
    empty = load.bronze_projection(src, T0).limit(0)
    assert load.watermark_df(empty).first()["watermark"] is None
    assert load.new_data_gate_df(src, None).first()["has_new_rows"] == 1
    assert load.new_data_gate_df(src, "2024-01-01 00:00:00").first()["has_new_rows"] == 1


def test_source_is_read_with_its_given_schema_and_the_watermark_is_pushed(spark, scratch):
    from conftest import SF_SMALL
    from tierwise.plans import queries

    scan = queries.queries()["bronze_incremental_batch"](spark, SF_SMALL)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(updatedAt" in plan
    whole = queries.queries()["source_scan"](spark, SF_SMALL)
    assert "ReadSchema: struct<id:string,customerId:string" in whole._jdf.queryExecution().executedPlan().toString()
