"""Month-partitioned, sorted Bronze writes; touched-month rewrite; retention; layer naming."""

import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import src_df
from tierwise.operators import load
from tierwise.plans import storage

T = "2025-01-10 00:00:00"


def bronze(spark, rows, as_of=T):
    return load.bronze_projection(src_df(spark, rows), as_of)


def test_layer_name():
    assert storage.layer_name("prod", "warehouse", "bronze_lake") == "bronze_lake"
    assert storage.layer_name("dev", "dev_me", " bronze_lake ") == "dev_me_bronze_lake"
    assert storage.layer_name("dev", "dev_me", None) == "dev_me"


def test_first_write_is_month_partitioned_and_sorted(spark, scratch):
    rows = [
        (f"id{i:03d}", "c", ["BOOKED", "DELIVERED"][i % 2], "X", "Y", f"2025-0{1 + i % 3}-15 00:00:00", f"2025-01-0{1 + i % 9} 00:00:00", None)
        for i in range(60)
    ]
    path = f"{scratch}/bronze"
    storage.write_bronze(path, bronze(spark, rows))
    assert sorted(storage.bronze_folders(spark, path)) == [202501, 202502, 202503]
    back = storage.read_bronze(spark, path)
    counts = {r["created_month"]: r["count"] for r in back.groupBy("created_month").count().collect()}
    assert counts == {202501: 20, 202502: 20, 202503: 20}
    # inside every file rows come in (updated date, status, id) order
    for f in back.select(F.input_file_name().alias("f")).distinct().collect():
        part = spark.read.parquet(f["f"]).collect()
        keys = [(r["updatedAt"].date(), r["lastStatus"], r["id"]) for r in part]
        assert keys == sorted(keys)


def test_upsert_rewrites_only_touched_months(spark, scratch):
    path = f"{scratch}/bronze"
    rows = [
        ("A", "c", "BOOKED", "X", "Y", "2025-01-15 00:00:00", "2025-01-15 00:00:00", None),
        ("B", "c", "BOOKED", "X", "Y", "2025-02-15 00:00:00", "2025-02-15 00:00:00", None),
    ]
    storage.write_bronze(path, bronze(spark, rows))
    jan = storage.bronze_folders(spark, path)[202501]
    jan_files = sorted(os.listdir(f"{path}/{jan}"))
    batch = bronze(spark, [("B", "c", "PROCESSING", "X", "Y", "2025-02-15 00:00:00", "2025-02-16 00:00:00", None)], "2025-02-17 00:00:00")
    storage.write_bronze(path, batch)
    assert storage.bronze_folders(spark, path)[202501] == jan
    assert sorted(os.listdir(f"{path}/{jan}")) == jan_files  # untouched month kept as is
    out = {r["id"]: r["lastStatus"] for r in storage.read_bronze(spark, path).collect()}
    assert out == {"A": "BOOKED", "B": "PROCESSING"}


def test_unstable_month_rewrites_whole_table(spark, scratch):
    path = f"{scratch}/bronze"
    storage.write_bronze(path, bronze(spark, [("A", "c", "BOOKED", "X", "Y", "2025-01-15 00:00:00", "2025-01-15 00:00:00", None)]))
    moved = bronze(spark, [("A", "c", "BOOKED", "X", "Y", "2025-03-15 00:00:00", "2025-03-16 00:00:00", None)])
    storage.write_bronze(path, moved, key_partition_stable=False)
    out = storage.read_bronze(spark, path).collect()
    assert [(r["id"], r["created_month"]) for r in out] == [("A", 202503)]


def test_drop_month_partitions_and_watermark_state(spark, scratch):
    path = f"{scratch}/bronze"
    rows = [
        ("A", "c", "BOOKED", "X", "Y", "2025-01-15 00:00:00", "2025-01-15 00:00:00", None),
        ("B", "c", "BOOKED", "X", "Y", "2025-02-15 00:00:00", "2025-02-15 00:00:00", None),
    ]
    storage.write_bronze(path, bronze(spark, rows))
    assert storage.drop_month_partitions(spark, path, [202501, 209912]) == [202501]
    assert [r["id"] for r in storage.read_bronze(spark, path).collect()] == ["B"]
    state = f"{scratch}/_state/bronze"
    assert storage.read_watermark(spark, state) is None
    storage.store_watermark(spark, state, "2025-02-15 00:00:00.000123", T, 2)
    assert storage.read_watermark(spark, state) == "2025-02-15 00:00:00.000123"


def test_mart_write_is_range_sorted(spark, scratch):
    df = spark.createDataFrame([(f"O{i % 7}", f"D{i % 5}", i) for i in range(100)], "pos_origin string, pos_destination string, n int")
    storage.write_table(df, f"{scratch}/m", "gold_delivery_success_rate")
    for f in spark.read.parquet(f"{scratch}/m").select(F.input_file_name().alias("f")).distinct().collect():
        keys = [(r["pos_origin"], r["pos_destination"]) for r in spark.read.parquet(f["f"]).collect()]
        assert keys == sorted(keys)


def test_nullable_partition_and_sort_keys(spark, scratch):
    """S10: NULL month (createdAt NULL) and NULL status/cities are written and read back intact."""
    path = f"{scratch}/bronze"
    rows = [
        ("A", "c", None, None, None, None, "2025-01-15 00:00:00", None),
        ("B", "c", "BOOKED", "X", "Y", "2025-01-15 00:00:00", "2025-01-15 00:00:00", None),
    ]
    storage.write_bronze(path, bronze(spark, rows))
    back = {r["id"]: r for r in storage.read_bronze(spark, path).collect()}
    assert back["A"]["created_month"] is None and back["A"]["lastStatus"] is None
    assert back["B"]["created_month"] == 202501
    # an upsert touching the NULL month rewrites it without losing the other month
    upd = bronze(spark, [("A", "c", "PROCESSING", None, None, None, "2025-01-16 00:00:00", None)], "2025-01-17 00:00:00")
    storage.write_bronze(path, upd)
    back = {r["id"]: r["lastStatus"] for r in storage.read_bronze(spark, path).collect()}
    assert back == {"A": "PROCESSING", "B": "BOOKED"}


def test_touched_month_read_is_partition_pruned(spark, scratch):
    path = f"{scratch}/bronze"
    rows = [
        ("A", "c", "BOOKED", "X", "Y", "2025-01-15 00:00:00", "2025-01-15 00:00:00", None),
        ("B", "c", "BOOKED", "X", "Y", "2025-02-15 00:00:00", "2025-02-15 00:00:00", None),
    ]
    storage.write_bronze(path, bronze(spark, rows))
    df = storage.read_bronze(spark, path).filter(F.col("created_month").isin(202502))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_month" in plan
    assert [r["id"] for r in df.collect()] == ["B"]


def rows_of(spark, path):
    return sorted((r["id"], r["lastStatus"]) for r in storage.read_bronze(spark, path).collect())


def row(i, status, created, updated):
    return (i, "c", status, "X", "Y", created, updated, None)


def test_repaired_created_at_gives_one_row(spark, scratch):
    path = f"{scratch}/bronze"
    storage.write_bronze(path, bronze(spark, [row("A", "BOOKED", None, "2025-01-15 00:00:00"), row("B", "BOOKED", "2025-01-15 00:00:00", "2025-01-15 00:00:00")]))
    storage.write_bronze(path, bronze(spark, [row("A", "PROCESSING", "2025-02-01 00:00:00", "2025-02-02 00:00:00")]))
    assert rows_of(spark, path) == [("A", "PROCESSING"), ("B", "BOOKED")]
    assert set(storage.bronze_folders(spark, path)) == {202501, 202502}  # the emptied NULL month is gone


@pytest.mark.parametrize("mode", ["static", "dynamic"])
def test_refresh_replaces_all_months_in_any_overwrite_mode(spark, scratch, mode):
    path = f"{scratch}/bronze"
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        storage.write_bronze(path, bronze(spark, [row("1", "BOOKED", "2025-01-15 00:00:00", "2025-01-15 00:00:00")]))
        storage.write_bronze(path, bronze(spark, [row("2", "BOOKED", "2025-02-15 00:00:00", "2025-02-15 00:00:00")]), replace=True)
    finally:
        spark.conf.set(key, before)
    assert rows_of(spark, path) == [("2", "BOOKED")]


@pytest.mark.parametrize("kwargs", [{}, {"replace": True}, {"key_partition_stable": False}, {"newer_wins": True}])
@pytest.mark.parametrize("where", ["task", "commit"])
def test_a_write_that_dies_leaves_the_old_table(spark, scratch, monkeypatch, kwargs, where):
    path = f"{scratch}/bronze"
    old = [row("A", "BOOKED", "2025-01-15 00:00:00", "2025-01-15 00:00:00"), row("B", "BOOKED", None, "2025-01-15 00:00:00")]
    new = bronze(spark, [row("A", "PROCESSING", "2025-01-15 00:00:00", "2025-01-16 00:00:00")])
    storage.write_bronze(path, bronze(spark, old))
    before = rows_of(spark, path)
    with monkeypatch.context() as m:
        if where == "commit":

            def dead(*a, **k):
                raise RuntimeError("driver lost")

            m.setattr(storage, "switch_months", dead)
            batch = new
        else:
            batch = new.withColumn("customerId", F.when(F.col("id") == "A", F.raise_error(F.lit("task lost")).cast("string")))
        with pytest.raises(Exception):  # noqa: B017
            storage.write_bronze(path, batch, **kwargs)
    assert rows_of(spark, path) == before
    storage.write_bronze(path, new, **kwargs)  # the retry equals an undisturbed run
    want = [("A", "PROCESSING")] if "replace" in kwargs else [("A", "PROCESSING"), ("B", "BOOKED")]
    assert rows_of(spark, path) == want


def test_first_write_that_dies_leaves_no_table(spark, scratch):
    path = f"{scratch}/bronze"
    bad = bronze(spark, [row("A", "BOOKED", None, "2025-01-15 00:00:00")]).withColumn("customerId", F.raise_error(F.lit("x")).cast("string"))
    with pytest.raises(Exception):  # noqa: B017
        storage.write_bronze(path, bad)
    assert storage.read_bronze(spark, path) is None and storage.bronze_folders(spark, path) == {}


def test_newer_wins_at_equal_times_by_life_cycle(spark, scratch):
    path = f"{scratch}/bronze"
    t = "2025-01-15 00:00:00"
    storage.write_bronze(path, bronze(spark, [row("A", "DELIVERED", t, t)]), newer_wins=True)
    storage.write_bronze(path, bronze(spark, [row("A", "BOOKED", t, t)]), newer_wins=True)
    assert rows_of(spark, path) == [("A", "DELIVERED")]


def test_write_partitions_follow_the_size(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 AS m")
    sizes = [storage.sorted_for_write(df, ["id"], ["m"], n).rdd.getNumPartitions() for n in (1, 300 << 20, 3 << 30)]
    assert sizes == [1, 2, 12]


@pytest.mark.parametrize("kwargs", [{}, {"replace": True}, {"key_partition_stable": False}])
@pytest.mark.parametrize("done", [1, 2])
def test_a_switch_that_dies_half_way_is_mended_by_the_rerun(spark, scratch, monkeypatch, kwargs, done):
    """Some months are switched, some not; each month is whole, and the rerun gives the undisturbed result."""
    path = f"{scratch}/bronze"
    old = [row("A", "BOOKED", "2025-01-15 00:00:00", "2025-01-15 00:00:00"), row("B", "BOOKED", "2025-02-15 00:00:00", "2025-01-15 00:00:00"), row("C", "BOOKED", None, "2025-01-15 00:00:00")]
    new = bronze(spark, [row("A", "PROCESSING", "2025-01-15 00:00:00", "2025-01-16 00:00:00"), row("B", "PROCESSING", "2025-02-15 00:00:00", "2025-01-16 00:00:00"), row("C", "PROCESSING", "2025-03-15 00:00:00", "2025-01-16 00:00:00")])
    storage.write_bronze(path, bronze(spark, old))
    real, calls = type(spark).sql, []

    def dying(self, query, *a, **k):
        if "LOCATION" in query and query.startswith("ALTER"):
            calls.append(query)
            if len(calls) > done:
                raise RuntimeError("driver lost")
        return real(self, query, *a, **k)

    with monkeypatch.context() as m:
        m.setattr(type(spark), "sql", dying)
        with pytest.raises(RuntimeError):
            storage.write_bronze(path, new, **kwargs)
    assert len(calls) > done  # months are switched side by side
    storage.write_bronze(path, new, **kwargs)
    assert rows_of(spark, path) == [("A", "PROCESSING"), ("B", "PROCESSING"), ("C", "PROCESSING")]


def test_left_behind_folders_go_with_the_next_load(spark, scratch):
    path = f"{scratch}/bronze"
    first = bronze(spark, [row("A", "BOOKED", "2025-01-15 00:00:00", "2025-01-15 00:00:00")])
    storage.write_bronze(path, first)
    (before,) = storage.stored_folders(storage.read_bronze(spark, path))
    assert before.endswith(storage.month_location(spark, path, 202501).removeprefix("file:"))
    storage.write_bronze(path, first)
    assert storage.path_exists(spark, before)  # a reader of the old month can finish
    storage.write_bronze(path, first)
    assert not storage.path_exists(spark, before)


def test_drop_partition_removes_files_and_reads_none(spark, scratch):
    path = f"{scratch}/bronze"
    storage.write_bronze(path, bronze(spark, [row("A", "BOOKED", "2025-01-15 00:00:00", "2025-01-15 00:00:00"), row("B", "BOOKED", None, "2025-01-15 00:00:00")]))
    files = storage.month_location(spark, path, 202501)
    assert storage.drop_month_partitions(spark, path, [202501, None]) == [202501, None]
    assert not storage.path_exists(spark, files) and storage.read_bronze(spark, path) is None


def test_what_is_observed_while_writing_counts_once(spark, scratch):
    path = f"{scratch}/bronze"
    rows = [row(f"id{i:04d}", "BOOKED", f"2025-0{1 + i % 4}-15 00:00:00", "2025-01-15 00:00:00") for i in range(2000)]
    for batch, replace, want in ((bronze(spark, rows).repartition(6), False, 2000), (bronze(spark, rows).limit(0), True, 0)):
        seen = Observation()
        storage.write_bronze(
            path, batch, replace, batch_bytes=5 << 30, watch=lambda df: df.observe(seen, F.count(F.lit(1)).alias("n"))
        )
        assert seen.get["n"] == want
        assert sorted(storage.bronze_months(spark, path)) == ([202501, 202502, 202503, 202504] if want else [])


def test_state_survives_any_text(spark, scratch):
    state = f"{scratch}/_state/bronze"
    storage.store_watermark(spark, state, "it's \\ \"x\"", T, 2, False, None, 7)
    assert storage.read_state(spark, state) == {
        "watermark": "it's \\ \"x\"", "load_at": T, "batch_rows": 2, "checks_passed": False, "gold_wm": None, "load_number": 7,
    }
