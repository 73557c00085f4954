"""E1-E4 against brute force on small inputs."""

import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tierwise.operators import extensions as ext
from tierwise.operators import gold
from tierwise.plans import scenarios as sc
from tierwise.sources import fixtures as fx

CHAIN = ["BOOKED", "PROCESSING", "IN_TRANSIT", "OUT_FOR_DELIVERY", "DELIVERED"]


def legal(prev, cur):
    if prev is None:
        return cur == "BOOKED"
    if prev == cur:
        return True
    if prev in CHAIN[:-1] and CHAIN[CHAIN.index(prev) + 1] == cur:
        return True
    return prev in CHAIN[:-1] and cur == "CANCELLED"


def test_transition_audit_with_hot_key_matches_brute_force(spark):
    rnd = random.Random(7)
    statuses = CHAIN + ["CANCELLED"]
    t0 = dt.datetime(2025, 1, 1)
    rows = []
    for key, n in [("hot", 900)] + [(f"k{i}", rnd.randint(1, 6)) for i in range(300)]:
        t = t0
        for v in range(n):
            t = t + dt.timedelta(minutes=rnd.randint(1, 300))
            rows.append((key, t, v, rnd.choice(statuses) if rnd.random() < 0.3 else CHAIN[min(v, 4)]))
    df = spark.createDataFrame(rows, "id string, updatedAt timestamp_ntz, version int, lastStatus string")
    def key(t):
        return tuple("" if v is None else v for v in t[:3]) + (t[3],)

    got = sorted(((r["id"], r["from_status"], r["to_status"], r["updated_at"]) for r in ext.status_transition_audit(df).collect()), key=key)
    expect = []
    by = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        prev = by.get(r[0])
        if not legal(prev, r[3]):
            expect.append((r[0], prev, r[3], r[1]))
        by[r[0]] = r[3]
    assert got == sorted(expect, key=key)
    assert any(e[0] == "hot" for e in expect)


def test_hard_delete_reconciliation(spark):
    got = ext.hard_delete_reconciliation(sc.clean_bronze(spark, SF_SMALL), fx.source_with_hard_deletes(spark, SF_SMALL))
    ks = sorted(int(r["id"][4:]) for r in got.collect())
    n = spark.read.parquet(f"{SF_SMALL}/orders.parquet").filter(F.col("o_orderkey") % 131 == 0).count()
    assert len(ks) == n and all(k % 131 == 0 for k in ks)


def test_incremental_mart_equals_full_rebuild(spark):
    rep = sc.replay(spark, SF_SMALL)
    old_b, new_b, batch = rep.states[-2], rep.states[-1], rep.batches[-1]
    from tierwise.operators.silver import silver_cleansed

    old_mart = gold.gold_daily_transaction_comprehensive(silver_cleansed(old_b), fx.AS_OF)
    inc = ext.incremental_daily_mart(old_mart, old_b, new_b, batch, fx.AS_OF).drop("processed_at")
    full = gold.gold_daily_transaction_comprehensive(silver_cleansed(new_b), fx.AS_OF).drop("processed_at")
    assert inc.exceptAll(full).count() == 0 and full.exceptAll(inc).count() == 0


def test_route_sla_threshold(spark):
    silver = sc.clean_silver(spark, SF_SMALL)
    sla = ext.route_sla_from_performance(gold.gold_route_performance_metrics(silver, fx.AS_OF))
    assert sla.filter((F.col("sla_hours") < 6) | (F.col("sla_hours") > 48)).count() == 0
    none = sla.limit(0)
    a = ext.aging_with_route_sla(silver, none, fx.AS_OF)
    b = gold.gold_aging_bottleneck_alerts(silver, fx.AS_OF)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0  # no SLA -> default 12 h


def test_clean_change_feed_has_only_legal_moves(spark):
    """Every move of the clean feed is legal (touches and soft deletes are same-status moves)."""
    assert ext.status_transition_audit(fx.retail_transaction_changes(spark, SF_SMALL)).count() == 0
    planted = ext.status_transition_audit(fx.changes_with_illegal_moves(spark, SF_SMALL))
    kinds = {(r["from_status"], r["to_status"]) for r in planted.collect()}
    # a PROCESSING version without a time starts a history, and the true start follows it
    assert kinds == {
        ("DELIVERED", "PROCESSING"), ("CANCELLED", "BOOKED"), ("IN_TRANSIT", "DELIVERED"), (None, "PROCESSING"), ("PROCESSING", "BOOKED")
    }


def test_transition_audit_keeps_rows_without_id_or_time(spark):
    t = dt.datetime(2025, 1, 1)
    rows = [
        ("a", t, 0, "BOOKED"), ("a", None, 1, "DELIVERED"), ("a", t + dt.timedelta(hours=5), 2, "IN_TRANSIT"),
        (None, t, 0, "PROCESSING"), (None, t + dt.timedelta(hours=1), 1, "IN_TRANSIT"),
    ]
    df = spark.createDataFrame(rows, "id string, updatedAt timestamp_ntz, version int, lastStatus string")
    got = {(r["id"], r["from_status"], r["to_status"]) for r in ext.status_transition_audit(df).collect()}
    assert got == {("a", None, "DELIVERED"), ("a", "DELIVERED", "BOOKED"), ("a", "BOOKED", "IN_TRANSIT"), (None, None, "PROCESSING")}


def test_hard_deletes_do_not_name_rows_without_id(spark):
    b = spark.createDataFrame([(None,), ("a",), ("b",)], "id string").selectExpr(
        "id", "'BOOKED' AS lastStatus", "1 AS createdAt", "1 AS updatedAt", "1 AS deletedAt", "1 AS load_at")
    gone = ext.hard_delete_reconciliation(b, spark.createDataFrame([(None,), ("a",)], "id string"))
    assert [r["id"] for r in gone.collect()] == ["b"]


def test_a_route_without_city_keeps_its_sla(spark):
    silver = sc.clean_silver(spark, SF_SMALL).limit(1).selectExpr(
        "'p' AS id", "customer_id", "'BOOKED' AS last_status", "CAST(NULL AS STRING) AS pos_origin", "pos_destination",
        "created_at", f"timestampadd(HOUR, -20, TIMESTAMP_NTZ '{fx.AS_OF}') AS updated_at", "deleted_at", "load_at", "0 AS is_deleted")
    sla = silver.selectExpr("pos_origin", "pos_destination", "48 AS sla_hours")
    assert ext.aging_with_route_sla(silver, sla, fx.AS_OF).count() == 0
    assert ext.aging_with_route_sla(silver, sla.withColumn("sla_hours", F.lit(6)), fx.AS_OF).count() == 1


def test_long_order_keys_keep_ids_apart(spark, scratch):
    import os
    import shutil

    os.makedirs(f"{scratch}/sf")
    for t in ("customer", "nation"):
        shutil.copy(f"{SF_SMALL}/{t}.parquet", f"{scratch}/sf/{t}.parquet")
    keys = [1, 12345678, 123456780, 123456789, 9_876_543_210]
    spark.createDataFrame([(k, 1, dt.datetime(1999, 1, 1)) for k in keys], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(
        f"{scratch}/sf/orders.parquet")
    rows = fx.retail_transactions(spark, f"{scratch}/sf")
    assert sorted(r[0] for r in rows.select(fx.order_key_of(F.col("id"))).collect()) == keys
    assert rows.select("id").distinct().count() == len(keys)


def test_a_history_in_one_hour_is_spread_and_exact(spark):
    """One id, and the versions without an id, each hold a third of the feed within one hour."""
    import datetime as dt

    rng = random.Random(4)
    steps = ["BOOKED", "PROCESSING", "IN_TRANSIT", "OUT_FOR_DELIVERY", "DELIVERED", "CANCELLED", None]
    start = dt.datetime(2025, 1, 1, 10)
    rows = []
    for who, n in (("hot", 2000), (None, 2000), *((f"id{i}", 4) for i in range(500))):
        rows += [(who, start + dt.timedelta(milliseconds=k), k, rng.choice(steps)) for k in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "id string, updatedAt timestamp_ntz, version int, lastStatus string").repartition(5)
    order = ["id", "updatedAt", "version", "lastStatus"]
    ranges = df.repartitionByRange(8, *order).withColumn("p", F.spark_partition_id()).groupBy("id").agg(F.count_distinct("p").alias("n"))
    spread = {r["id"]: r["n"] for r in ranges.where("id IS NULL OR id = 'hot'").collect()}
    assert all(n > 1 for n in spread.values())
    want, before = [], {}
    for who, at, k, s in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2])):
        p = before.get(who, None)
        active = ("BOOKED", "PROCESSING", "IN_TRANSIT", "OUT_FOR_DELIVERY")
        chain = steps[:5]
        if p is None:
            legal = s == "BOOKED"
        else:
            legal = s is not None and (s == p or (p in chain[:-1] and s == chain[chain.index(p) + 1]) or (p in active and s == "CANCELLED"))
        if not legal:
            want.append((who, p, s, at))
        before[who] = s
    got = [tuple(r) for r in ext.status_transition_audit(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_hard_deletes_read_the_differing_ranges_only(spark, scratch):
    rows = [(f"TRX-{k:08d}", "BOOKED") for k in range(20000)]
    full = spark.createDataFrame(rows, "id string, lastStatus string").selectExpr(
        "id", "lastStatus", *[f"TIMESTAMP_NTZ '2025-01-01 00:00:00' AS {c}" for c in ("createdAt", "updatedAt", "deletedAt", "load_at")]
    )
    full.repartitionByRange(8, "id").sortWithinPartitions("id").write.parquet(f"{scratch}/b")
    full.where("id NOT IN ('TRX-00000000', 'TRX-00012345')").select("id").repartitionByRange(8, "id").write.parquet(f"{scratch}/s")
    bronze, source = spark.read.parquet(f"{scratch}/b"), spark.read.parquet(f"{scratch}/s")
    prefix = ext.id_ranges(bronze.select("id"))
    ranges = ext.differing_ranges(bronze, source, prefix)
    assert len(ranges) == 2 and bronze.select(F.substring("id", 1, prefix)).distinct().count() <= ext.MOST_RANGES
    gone = ext.hard_delete_reconciliation(bronze, source)
    assert sorted(r["id"] for r in gone.collect()) == ["TRX-00000000", "TRX-00012345"]
    plan = gone._jdf.queryExecution().executedPlan().toString()
    assert plan.count("StringStartsWith(id") >= 2
    assert ext.in_ranges(bronze, ranges, prefix).count() < 100
    same = ext.hard_delete_reconciliation(bronze, bronze)
    assert same.count() == 0 and ext.differing_ranges(bronze, bronze, prefix) == []


def test_hard_deletes_of_ids_of_any_length(spark):
    ids = ["", "a", "ab", "abc", "é", "b" * 50, "b" * 49, None, "dup", "dup"]
    b = spark.createDataFrame([(i, *[None] * 5) for i in ids], "id string, lastStatus string, createdAt string, updatedAt string, deletedAt string, load_at string")
    for gone in ({"a"}, {"", "abc"}, {"b" * 50}, {"dup", "é"}, set(ids) - {None}, set()):
        s = spark.createDataFrame([(i,) for i in ids if i not in gone] + [("zzz",)], "id string")
        got = sorted(r["id"] for r in ext.hard_delete_reconciliation(b, s).collect())
        assert got == sorted(i for i in ids if i in gone and i is not None)
