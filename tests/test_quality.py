"""Each check on passing and failing input; fail-fast build; crash between write and commit."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, src_df
from tierwise.operators import gold, load, quality
from tierwise.operators.silver import silver_cleansed
from tierwise.plans import pipeline, scenarios as sc, storage
from tierwise.schemas import STATUSES
from tierwise.sources import fixtures as fx

AS_OF = "2025-01-02 00:00:00"
GOOD = [
    ("A", "c", "BOOKED", "X", "Y", "2025-01-01 00:00:00", "2025-01-01 01:00:00", None),
    ("B", "c", "DELIVERED", "X", "Y", "2025-01-01 00:00:00", "2025-01-01 03:00:00", None),
]


def test_generic_checks_pass_on_clean_rows(spark):
    b = load.bronze_projection(src_df(spark, GOOD), AS_OF)
    s = silver_cleansed(b)
    assert quality.dq_unique(b, "id").count() == 0
    assert quality.dq_not_null(b, "lastStatus").count() == 0
    assert quality.dq_accepted_values(b, "lastStatus", STATUSES).count() == 0
    assert quality.dq_is_deleted_consistent(s).count() == 0
    cols = [c for c in s.columns if c != "deleted_at"]  # NULL unless soft deleted
    assert all(r["failures"] == 0 for r in quality.null_counts(s, cols).collect())


def test_generic_checks_report_violations(spark):
    bad = GOOD + [
        ("A", "c", "BOOKED", "X", "Y", "2025-01-01 00:00:00", "2025-01-01 01:00:00", None),
        ("C", "c", None, "X", "Y", "2025-01-01 00:00:00", "2025-01-01 01:00:00", None),
        ("D", "c", "DELIVRED", "X", "Y", "2025-01-01 00:00:00", "2025-01-01 01:00:00", None),
        ("E", "c", "DELIVRED", "X", "Y", "2025-01-01 00:00:00", "2025-01-01 01:00:00", None),
    ]
    b = load.bronze_projection(src_df(spark, bad), AS_OF)
    assert [(r["value"], r["n_records"]) for r in quality.dq_unique(b, "id").collect()] == [("A", 2)]
    assert quality.dq_not_null(b, "lastStatus").count() == 1
    assert [(r["value"], r["n_records"]) for r in quality.dq_accepted_values(b, "lastStatus", STATUSES).collect()] == [("DELIVRED", 2)]


def test_singular_checks_on_planted_marts(spark):
    silver = sc.clean_silver(spark, SF_SMALL)
    assert quality.dq_is_deleted_consistent(silver).count() == 0
    assert quality.dq_is_deleted_consistent(fx.plant_flag_flips(silver)).count() > 0
    v = gold.gold_daily_transaction_valid(silver, fx.AS_OF)
    c = gold.gold_daily_transaction_comprehensive(silver, fx.AS_OF)
    assert quality.dq_daily_grain_unique(v, c).count() == 0
    pv, pc = fx.plant_grain_duplicates(v, c)
    assert quality.dq_daily_grain_unique(pv, pc).count() > 0
    m3 = gold.gold_route_performance_metrics(silver, fx.AS_OF)
    assert quality.dq_route_lead_time_valid(m3).count() == 0
    m5 = gold.gold_delivery_success_rate(silver, fx.AS_OF)
    assert quality.dq_success_rate_bounds(m5).count() == 0


def test_suite_has_23_checks(spark):
    layers = {
        "bronze_retail_transactions": sc.clean_bronze(spark, SF_SMALL),
        "silver_retail_transactions_cleansed": sc.clean_silver(spark, SF_SMALL),
    }
    for name, fn in gold.MARTS.items():
        layers[name] = fn(layers["silver_retail_transactions_cleansed"], fx.AS_OF)
    rows = quality.dq_suite_summary(layers, STATUSES).collect()
    assert len(rows) == 23
    assert sum(1 for r in rows if r["test_name"] == "not_null") == 14
    assert all(r["failures"] == 0 for r in rows)


def test_fail_fast_leaves_later_layers_unwritten(spark, scratch):
    wh = storage.Warehouse(scratch)
    with pytest.raises(pipeline.DataQualityError) as err:
        pipeline.build(spark, sc.dirty_source(spark, SF_SMALL), wh, fx.AS_OF)
    assert err.value.layer == "bronze_retail_transactions"
    assert any(t == "accepted_values" for _, t, _, _ in err.value.failed)
    for name in gold.MARTS:
        assert not storage.path_exists(spark, wh.path("gold", name))


def test_a_broken_silver_stops_the_build_before_gold(spark, scratch, monkeypatch):
    """Inverted flags, lower-case statuses and lost ids in Silver are found in Silver, on the first and
    on a later load; Bronze itself is fine."""
    real = pipeline.silver_cleansed

    def broken(bronze, keep=()):
        out = real(bronze, keep)
        return out.withColumn("is_deleted", 1 - F.col("is_deleted")).withColumn("last_status", F.lower("last_status")).withColumn(
            "id", F.lit(None).cast("string")
        )

    wh = storage.Warehouse(scratch)
    changes = fx.retail_transaction_changes(spark, SF_SMALL)
    cuts = fx.REPLAY_CUTS
    for i, cut in enumerate(cuts[:2]):
        with monkeypatch.context() as m:
            m.setattr(pipeline, "silver_cleansed", broken)
            with pytest.raises(pipeline.DataQualityError) as err:
                pipeline.build(spark, fx.snapshot_at(changes, cut), wh, cut)
        assert err.value.layer == "silver_retail_transactions_cleansed"
        tests = {(t, c) for _, t, c, _ in err.value.failed}
        assert {("not_null", "id"), ("accepted_values", "last_status"), ("assert_silver_is_deleted_consistent", None)} <= tests
        if i == 0:
            assert not any(storage.path_exists(spark, wh.path("gold", name)) for name in gold.MARTS)
            pipeline.build(spark, fx.snapshot_at(changes, cut), wh, cut, force=True)
    layers = {"bronze_retail_transactions": sc.clean_bronze(spark, SF_SMALL)}
    layers["silver_retail_transactions_cleansed"] = broken(layers["bronze_retail_transactions"])
    rows = quality.dq_suite_summary(layers, STATUSES).collect()
    assert all((r["failures"] > 0) == (r["model"].startswith("silver") and (r["test_name"], r["column_name"]) in tests) for r in rows)


def test_crash_after_bronze_write_before_commit_is_recovered(spark, scratch):
    """The watermark is stored only after the Bronze write; a run that dies in between is simply
    repeated, and the result equals an uninterrupted run."""
    wh = storage.Warehouse(scratch)
    changes = fx.retail_transaction_changes(spark, SF_SMALL)
    cuts = fx.REPLAY_CUTS
    pipeline.build(spark, fx.snapshot_at(changes, cuts[0]), wh, cuts[0])
    real_store = storage.store_watermark

    def boom(*a, **k):
        raise RuntimeError("driver lost")

    storage.store_watermark = boom
    try:
        with pytest.raises(RuntimeError):
            pipeline.build(spark, fx.snapshot_at(changes, cuts[1]), wh, cuts[1])
    finally:
        storage.store_watermark = real_store
    assert storage.read_watermark(spark, wh.state_path(pipeline.BRONZE)) < cuts[0]
    for cut in cuts[1:]:
        pipeline.build(spark, fx.snapshot_at(changes, cut), wh, cut)
    bronze = storage.read_bronze(spark, wh.path("bronze", pipeline.BRONZE))
    final = fx.snapshot_at(changes, cuts[-1])
    got = bronze.select(*final.columns)
    assert got.count() == final.count() == got.select("id").distinct().count()
    assert got.exceptAll(final).count() == 0


def test_unique_with_a_hot_duplicated_id(spark):
    """One id holds a third of all rows; the check counts it exactly in each layer."""
    rows = [(" hot", "BOOKED")] * 3000 + [(f"k{i}", "BOOKED") for i in range(5000)] + [("k1 ", "BOOKED")] * 2 + [("k2", "BOOKED")]
    df = spark.createDataFrame(rows, "id string, lastStatus string").repartition(8)
    trimmed = df.withColumn("id", F.trim("id")).where("id <> 'k2'")
    got = {r["model"]: r["failures"] for r in quality.unique_ids({"b": df, "s": trimmed}).collect()}
    # raw duplicates: ' hot', 'k1 ', 'k2'; trimmed duplicates: 'hot', 'k1'
    assert got == {"b": 3, "s": 2}
    assert quality.dq_unique(df, "id").count() == 3


def test_incremental_checks_catch_what_full_checks_catch(spark, scratch):
    """After clean loads (state: checks passed) the next load is checked incrementally; an id moved to
    another month (breaking the month-stability assumption) duplicates it, and the incremental check
    reports exactly what the full check reports."""
    from pyspark.sql import functions as F

    wh = storage.Warehouse(scratch)
    changes = fx.retail_transaction_changes(spark, SF_SMALL)
    for cut in fx.REPLAY_CUTS:
        pipeline.build(spark, fx.snapshot_at(changes, cut), wh, cut)
    assert storage.read_state(spark, wh.state_path(pipeline.BRONZE))["checks_passed"] is True
    bronze = storage.read_bronze(spark, wh.path("bronze", pipeline.BRONZE))
    victim = bronze.orderBy("id").select(*fx.SOURCE_COLUMNS).limit(1)
    moved = victim.withColumn("createdAt", F.expr("timestampadd(YEAR, 3, createdAt)")).withColumn(
        "updatedAt", F.expr("TIMESTAMP_NTZ '2001-09-02 00:00:00'")
    )
    later = "2001-09-02 01:00:00"
    rep = pipeline.build(spark, moved, wh, later, fail_fast=False, check_scope="auto")
    inc = {r["model"]: r["failed_checks"] for r in rep.collect()}
    assert "bronze_retail_transactions.unique" in inc["bronze_retail_transactions"]
    assert "silver_retail_transactions_cleansed.unique" in inc["silver_retail_transactions_cleansed"]
    assert storage.read_state(spark, wh.state_path(pipeline.BRONZE))["checks_passed"] is False
    from tierwise.schemas import STATUSES as ST

    b = storage.read_bronze(spark, wh.path("bronze", pipeline.BRONZE))
    full = {(r["model"], r["test_name"]): r["failures"] for r in quality.layer_checks(b, silver_cleansed(b), "B", "S", ST).collect()}
    assert full[("B", "unique")] == 1 and full[("S", "unique")] == 1


def test_run_hourly_then_ad_hoc_sql(spark, scratch):
    wh = storage.Warehouse(scratch, target="dev", default_schema="dev_me")
    rep = pipeline.run_hourly(spark, sc.clean_source(spark, SF_SMALL), wh, fx.AS_OF)
    assert {r["status"] for r in rep.collect()} == {"success"}
    assert "dev_me_gold_lake" in wh.path("gold", "x")
    names = pipeline.register_views(spark, wh)
    assert len(names) == 7
    direct = gold.gold_delivery_success_rate(sc.clean_silver(spark, SF_SMALL), fx.AS_OF)
    via_sql = spark.sql("SELECT * FROM gold_delivery_success_rate")
    assert via_sql.count() == direct.count()
    assert via_sql.select(*direct.columns).exceptAll(direct).count() == 0
    top = spark.sql(
        "SELECT pos_origin, pos_destination, total_packages FROM gold_delivery_success_rate "
        "ORDER BY total_packages DESC, pos_origin, pos_destination LIMIT 4"
    ).collect()
    assert len(top) == 4


def test_incremental_gold_equals_full_rebuild(spark, scratch):
    """Four hourly loads with incremental Gold (signed counts) give exactly the marts of a
    full rebuild over the final Bronze."""
    from tierwise.plans import incremental_gold as ig

    calls = []
    real = ig.add_changes

    def counting(*a, **k):
        calls.append(1)
        return real(*a, **k)

    wh = storage.Warehouse(scratch)
    changes = fx.retail_transaction_changes(spark, SF_SMALL)
    ig.add_changes = counting
    try:
        for cut in fx.REPLAY_CUTS:
            pipeline.build(spark, fx.snapshot_at(changes, cut), wh, cut)
    finally:
        ig.add_changes = real
    assert len(calls) == len(fx.REPLAY_CUTS) - 1  # every load after the first was incremental
    state = storage.read_state(spark, wh.state_path(pipeline.BRONZE))
    assert state["gold_wm"] == state["watermark"] and state["load_number"] == len(fx.REPLAY_CUTS)
    silver = silver_cleansed(storage.read_bronze(spark, wh.path("bronze", pipeline.BRONZE)).drop("created_month"))
    for name, fn in gold.MARTS.items():
        got = spark.read.parquet(wh.path("gold", name))
        want = fn(silver, fx.REPLAY_CUTS[-1])
        assert sorted(got.columns) == sorted(want.columns), name
        g = got.select(*want.columns)
        assert g.exceptAll(want).count() == 0 and want.exceptAll(g).count() == 0, name


def test_full_refresh_full_gold_and_unstable_months_agree(spark, scratch):
    """Full refresh, gold_mode='full' and key_partition_stable=False reach the same end state."""
    changes = fx.retail_transaction_changes(spark, SF_SMALL)
    cuts = fx.REPLAY_CUTS
    a = storage.Warehouse(f"{scratch}/a")
    b = storage.Warehouse(f"{scratch}/b")
    for cut in cuts[:2]:
        pipeline.build(spark, fx.snapshot_at(changes, cut), a, cut, gold_mode="full")
        pipeline.build(spark, fx.snapshot_at(changes, cut), b, cut, key_partition_stable=False, check_scope="full")
    # a forced full refresh of the latest source replaces everything
    pipeline.build(spark, fx.snapshot_at(changes, cuts[-1]), a, cuts[-1], full_refresh=True)
    pipeline.build(spark, fx.snapshot_at(changes, cuts[-1]), b, cuts[-1], key_partition_stable=False)
    for name in ["bronze_retail_transactions"]:
        x = storage.read_bronze(spark, a.path("bronze", name)).drop("load_at")
        y = storage.read_bronze(spark, b.path("bronze", name)).drop("load_at")
        assert x.count() == y.count() == x.select("id").distinct().count()
        assert x.exceptAll(y).count() == 0
    for name in gold.MARTS:
        x = spark.read.parquet(a.path("gold", name)).drop("processed_at")
        y = spark.read.parquet(b.path("gold", name)).drop("processed_at")
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, name
