"""Work that is done once: snapshots of all cuts in one pass over the feed, loads over written sources."""

import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL, src_df, ts
from tierwise.operators import deltas, load, quality
from tierwise.plans import pipeline, storage
from tierwise.plans import scenarios as sc
from tierwise.plans.pipeline import BRONZE, SILVER
from tierwise.schemas import SOURCE_COLUMNS, source_schema
from tierwise.sources import fixtures as fx
from tierwise.streaming.stream_upsert import upsert_micro_batch

FEED = T.StructType([T.StructField(f.name, f.dataType, True) for f in source_schema()] + [T.StructField("version", T.IntegerType())])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def feed(spark):
    def row(id, status, at, version, origin="X"):
        return (id, "c", status, origin, None, ts("2025-01-01 00:00:00"), ts(at) if at else None, None, version)

    rows = [
        row("A", "BOOKED", "2025-01-01 10:00:00", 0),
        row("A", "PROCESSING", "2025-01-02 10:00:00", 1),  # exactly at a cut
        row("A", "IN_TRANSIT", "2025-01-02 10:00:00", 2),  # same time, greater version
        row("A", "IN_TRANSIT", "2025-01-02 10:00:00", 2, "Y"),  # a full tie: the greater payload
        row("B", "BOOKED", "2025-01-03 00:00:00", 0),
        row("B", "BOOKED", None, 1),  # no time: in no snapshot
        row("C", "BOOKED", "2025-02-01 00:00:00", 0),  # after all cuts
        row("D", "DELIVERED", "2025-01-01 00:00:00", None),
        row("D", "DELIVERED", "2025-01-01 00:00:00", 0),
        row(None, "BOOKED", "2025-01-01 00:00:00", 0),
        row(None, "PROCESSING", "2025-01-02 12:00:00", 0),
        row("D", None, "2025-01-02 10:00:01", 1),
    ]
    return spark.createDataFrame(rows, FEED)


def test_snapshots_of_all_cuts_in_one_pass_equal_one_by_one(spark):
    cuts = ("2025-01-02 10:00:00", "2025-01-01 09:00:00", "2025-01-05 00:00:00", "2024-01-01 00:00:00", "2025-01-02 10:00:00")
    changes = feed(spark)
    got = fx.snapshots_at(changes, cuts)
    for i, cut in enumerate(cuts):
        mine = sorted(map(repr, got.filter(F.col("cut") == i).select(*SOURCE_COLUMNS).collect()))
        assert mine == sorted(map(repr, fx.snapshot_at(changes, cut).collect())), cut
    one = fx.snapshots_at(changes, cuts[:1]).drop("cut")
    assert sorted(map(repr, one.collect())) == sorted(map(repr, fx.snapshot_at(changes, cuts[0]).collect()))


def test_loads_of_a_replay_read_written_sources(spark):
    rep = sc.replay(spark, SF_SMALL)
    changes = fx.retail_transaction_changes(spark, SF_SMALL, fx.AS_OF)
    for src, batch, state, cut in zip(rep.sources, rep.batches, rep.states, fx.REPLAY_CUTS):
        # neither the feed nor its aggregate is run again for a source, a batch or a state
        for df in (src, batch, state):
            assert "Exchange" not in plan(df) and "ExistingRDD" not in plan(df)
        want = fx.snapshot_at(changes, cut)
        assert src.exceptAll(want).count() == 0 and want.exceptAll(src).count() == 0


def test_exports_before_the_first_row_are_empty(spark, scratch):
    old, new = sc.source_exports(spark, SF_SMALL, ("1970-01-01 00:00:00", fx.AS_OF), f"{scratch}/source")
    assert sc.read_source(spark, old).count() == 0
    assert sc.read_source(spark, new).count() == fx.retail_transactions(spark, SF_SMALL).count()


def test_dedup_carries_named_keys_once(spark):
    log = load.with_partition_column(load.bronze_projection(feed(spark).drop("version"), "2025-02-02 00:00:00"))
    out = load.dedup_versions(log, load.bronze_sort_key(), partition=["created_month"])
    text = plan(out)
    assert "_dk1" in text and "_dk0" not in text and "_dk2" not in text
    assert out.columns == log.columns
    keys = [r[:] for r in log.selectExpr("created_month", "to_date(updatedAt)", "lastStatus", "id").distinct().collect()]
    assert out.count() == len(keys)


def test_a_micro_batch_is_worked_out_once(spark, scratch):
    seen = spark.sparkContext.accumulator(0)

    def count(id):
        seen.add(1)
        return id

    counted = F.udf(count, "string").asNondeterministic()
    path = f"{scratch}/stream/bronze"
    rows = feed(spark).filter("id IS NOT NULL AND updatedAt IS NOT NULL").coalesce(1)
    loads = ("version = 0 OR version IS NULL", "version = 1", "version = 2 OR id = 'C'", "version = 0", "version = 9")
    for load_rows in loads:  # a first load, newer ones, a replay of the first, an empty one
        batch = rows.filter(load_rows)
        before = seen.value
        upsert_micro_batch(batch.withColumn("id", counted("id")), path, "2025-03-01 00:00:00", ("updatedAt", "version"))
        assert seen.value - before == batch.count()
    stored = storage.read_bronze(spark, path)
    latest = fx.snapshot_at(rows, "2025-03-01 00:00:00")
    got, want = ({r["id"]: (r["lastStatus"], r["updatedAt"]) for r in df.collect()} for df in (stored, latest))
    # without a version number the stored row is kept at equal times unless the life cycle moves on
    assert stored.count() == len(got) and got == want


# --- builds -----------------------------------------------------------------------------------
def source_row(id, status="BOOKED", day=1):
    return (id, "c", status, "X", "Y", "2025-01-01 00:00:00", f"2025-01-{day:02d} 12:00:00", None)


def test_ids_unique_in_silver_are_not_counted_again_in_bronze(spark, scratch, monkeypatch):
    asked = []
    real = quality.unique_ids

    def noted(tables, *a):
        asked.append(list(tables))
        return real(tables, *a)

    monkeypatch.setattr(quality, "unique_ids", noted)
    cases = (
        ([source_row("B", day=3)], "", ""),
        ([source_row("A ", day=3)], "", f"{SILVER}.unique"),
        ([source_row("C", day=3), source_row("C", "DELIVERED", 3)], f"{BRONZE}.unique", f"{SILVER}.unique"),
    )
    for n, (rows, bronze_fails, silver_fails) in enumerate(cases):
        wh = storage.Warehouse(f"{scratch}/{n}")
        pipeline.build(spark, src_df(spark, [source_row("A")]), wh, "2025-01-02 00:00:00")
        assert asked == [[SILVER]]  # a clean load: one pass over the ids
        report = pipeline.build(spark, src_df(spark, [source_row("A"), *rows]), wh, "2025-01-04 00:00:00", fail_fast=False)
        found = {r["model"]: [f for f in r["failed_checks"] if f.endswith(".unique")] for r in report.collect()}
        assert ",".join(found[BRONZE]) == bronze_fails and ",".join(found[SILVER]) == silver_fails
        asked.clear()


def test_replaced_versions_are_counted_while_the_months_are_written(spark, scratch, monkeypatch):
    path = f"{scratch}/w/bronze"
    storage.write_bronze(path, load.bronze_projection(src_df(spark, [source_row("A")]), "2025-01-02 00:00:00"))
    counting, real = threading.Event(), storage.sorted_for_write
    seen = []

    def write_waits(*a, **k):
        assert counting.wait(60)
        return real(*a, **k)

    def beside():
        counting.set()
        seen.extend(r["lastStatus"] for r in storage.read_bronze(spark, path).collect())

    monkeypatch.setattr(storage, "sorted_for_write", write_waits)
    batch = load.bronze_projection(src_df(spark, [source_row("A", "DELIVERED", 3)]), "2025-01-04 00:00:00")
    storage.write_bronze(path, batch, beside=beside)
    assert seen == ["BOOKED"]  # the table as it was
    assert [r["lastStatus"] for r in storage.read_bronze(spark, path).collect()] == ["DELIVERED"]

    def dies():
        raise RuntimeError("counts lost")

    with pytest.raises(RuntimeError):
        storage.write_bronze(path, load.bronze_projection(src_df(spark, [source_row("A", "CANCELLED", 5)]), "2025-01-06 00:00:00"), beside=dies)
    assert [r["lastStatus"] for r in storage.read_bronze(spark, path).collect()] == ["DELIVERED"]  # not switched


def test_daily_marts_sum_a_base_and_its_deltas_in_one_exchange(spark):
    grain = "transaction_date date, last_status string, pos_origin string, pos_destination string, is_deleted int, n_rows long, n_id long"
    day = ts("2025-01-01 00:00:00").date()

    def cell(status, origin, deleted, n_rows, n_id):
        return (day, status, origin, None, deleted, n_rows, n_id)

    base = [cell("BOOKED", "X", 0, 3, 2), cell("BOOKED", "Z", 0, 1, 1), cell("BOOKED", None, 0, 2, 0), cell("DELIVERED", "X", 0, 2, 2), cell("BOOKED", "W", 0, 1, 1)]
    delta = [
        cell("BOOKED", "X", 0, -1, 0), cell("BOOKED", "Z", 0, -1, -1), cell("DELIVERED", "X", 0, -1, -1),
        cell("DELIVERED", "X", 1, 1, 1), cell("CANCELLED", "Z", 0, 1, 1), cell("BOOKED", "W", 0, -1, -1), cell("BOOKED", "W", 1, 1, 1),
    ]
    stored = spark.createDataFrame(base + delta, grain)
    once = deltas.merged("daily", stored)
    for mart in (deltas.daily_valid, deltas.daily_comprehensive, deltas.success_rate):
        got, want = mart(stored, fx.AS_OF), mart(once, fx.AS_OF)
        assert plan(got).count("Exchange hashpartitioning") == 1
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    valid = {(r["last_status"], r["pos_origin"]): r["total_valid_transactions"] for r in deltas.daily_valid(stored, fx.AS_OF).collect()}
    assert valid == {("BOOKED", "X"): 2, ("BOOKED", None): 0, ("DELIVERED", "X"): 1}


def test_a_build_sums_the_stored_daily_counts(spark, scratch):
    from tierwise.plans import incremental_gold as ig

    wh = storage.Warehouse(scratch)
    pipeline.build(spark, src_df(spark, [source_row("A")]), wh, "2025-01-02 00:00:00")
    pipeline.build(spark, src_df(spark, [source_row("A", "DELIVERED", 3)]), wh, "2025-01-04 00:00:00")
    assert ig.mart_counts(spark, wh)["daily"].count() == 3  # +1, and -1 +1; nothing is aggregated before the marts
    rows = spark.read.parquet(wh.path("gold", "gold_daily_transaction_comprehensive")).collect()
    assert [(r["last_status"], r["total_transactions"]) for r in rows] == [("DELIVERED", 1)]
