"""Signed counts: marts after inserts, changes, moves and deletions equal the marts of a rebuild."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, src_df
from tierwise.operators import deltas, extensions, gold, load
from tierwise.operators.silver import silver_cleansed
from tierwise.plans import incremental_gold as ig
from tierwise.plans import pipeline, storage
from tierwise.plans import scenarios as sc
from tierwise.sources import fixtures as fx

T = "2025-03-01 00:00:00"


def history(seed, n=60):
    """Versions of parcels: (rows of the first load, rows of the next loads)."""
    rng = random.Random(seed)
    status = ["BOOKED", "IN_TRANSIT", " delivered", "DELIVERED", "CANCELLED", None, "Delivered "]

    def version(i):
        hour = rng.randrange(24 * 50)
        made = None if rng.random() < 0.1 else f"2025-01-{1 + i % 3:02d} {i % 24:02d}:30:00"
        at = f"2025-0{1 + hour // 672}-{1 + hour // 24 % 28:02d} {hour % 24:02d}:59:59"
        gone = at if rng.random() < 0.25 else None
        return ("-" if i == 7 else f"id{i}", "c", rng.choice(status), rng.choice(["X", "X ", None]), rng.choice(["Y", "Z"]), made, at, gone)

    return [version(i) for i in range(n)], [[version(rng.randrange(n + 10)) for _ in range(15)] for _ in range(3)]


def bronze_of(spark, rows):
    return load.bronze_projection(src_df(spark, rows).withColumn("id", F.expr("nullif(id, '-')")), T)


def same(a, b):
    a = a.select(*b.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_marts_after_signed_changes_equal_a_rebuild(spark, seed):
    first, batches = history(seed)
    bronze = bronze_of(spark, first)
    parts = [deltas.finest_counts(bronze)]
    for rows in batches:
        unique = list({r[0]: r for r in rows if r[0] != "-"}.values()) + [r for r in rows if r[0] == "-"]
        batch = bronze_of(spark, unique)
        parts.append(deltas.finest_counts(deltas.signed_changes(bronze, batch)))
        bronze = load.upsert_by_key(bronze, batch, "id").checkpoint()
    rolled = [deltas.roll_up(p) for p in parts]
    counts = {n: deltas.merged(n, *[r[n] for r in rolled]) for n in deltas.GRAINS}
    silver = silver_cleansed(bronze)
    for name, mart in deltas.marts(counts, T).items():
        same(mart, gold.MARTS[name](silver, T))
    for as_of in ("2025-01-20 10:00:00", "2025-02-02 00:00:00", "2025-06-01 23:59:59"):
        same(deltas.aging_alerts(counts["active"], as_of), gold.gold_aging_bottleneck_alerts(silver, as_of))
        sla = spark.createDataFrame([("X", "Y", 30), (None, "Z", 2000)], "pos_origin string, pos_destination string, sla_hours int")
        same(deltas.aging_alerts_by_sla(counts["active"], sla, as_of), extensions.aging_with_route_sla(silver, sla, as_of))


def test_extremes_after_the_fastest_parcel_is_deleted(spark):
    def parcel(i, hours, gone=None):
        return (i, "c", "DELIVERED", "X", "Y", "2025-01-01 00:00:00", f"2025-01-{1 + hours // 24:02d} {hours % 24:02d}:00:00", gone)

    old = load.bronze_projection(src_df(spark, [parcel("A", 5), parcel("B", 9), parcel("C", 30), parcel("D", 30)]), T)
    base = deltas.roll_up(deltas.finest_counts(old))["lead"]
    batch = load.bronze_projection(src_df(spark, [parcel("A", 200, "2025-01-09 08:00:00"), parcel("C", 201, "2025-01-09 09:00:00")]), T)
    delta = deltas.roll_up(deltas.finest_counts(deltas.signed_changes(old, batch)))["lead"]
    row = deltas.route_performance(deltas.merged("lead", base, delta), T).first()
    assert (row["total_delivered_packages"], row["fastest_delivery_hours"], row["slowest_delivery_hours"]) == (2, 9, 30)
    assert row["avg_delivery_time_hours"] == 19.5
    # the route goes when its last parcel does
    rest = load.bronze_projection(src_df(spark, [parcel("B", 210, T), parcel("D", 210, T)]), T)
    last = deltas.roll_up(deltas.finest_counts(deltas.signed_changes(old, rest)))["lead"]
    assert deltas.route_performance(deltas.merged("lead", base, delta, last), T).count() == 0


def test_a_load_reads_the_batch_and_the_months_of_the_replaced_rows(spark, scratch):
    path = f"{scratch}/w/bronze"
    rows = [(f"id{m}", "c", "BOOKED", "X", "Y", f"2025-{m:02d}-15 00:00:00", "2025-01-15 00:00:00", None) for m in range(1, 7)]
    storage.write_bronze(path, load.bronze_projection(src_df(spark, rows), T))
    batch = load.bronze_projection(src_df(spark, [("id2", "c", "DELIVERED", "X", "Y", "2025-02-15 00:00:00", "2025-02-16 00:00:00", None)]), T)
    old = storage.read_bronze(spark, path).filter(load.months_filter([202502, None]))
    found = deltas.signed_changes(old, batch)
    assert "created_month" in found._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert sorted((r["id"], r["_sign"]) for r in found.collect()) == [("id2", -1), ("id2", 1)]


def test_folding_deltas_into_a_base_changes_nothing(spark, scratch, monkeypatch):
    monkeypatch.setattr(storage, "DELTAS_KEPT", 2)
    wh = storage.Warehouse(scratch)
    changes = fx.retail_transaction_changes(spark, SF_SMALL)
    for cut in fx.REPLAY_CUTS:
        pipeline.build(spark, fx.snapshot_at(changes, cut), wh, cut)
    assert len(storage._loads(spark, ig.counts_path(wh, "daily"))) < len(fx.REPLAY_CUTS)
    silver = silver_cleansed(storage.read_bronze(spark, wh.path("bronze", pipeline.BRONZE)))
    for name, fn in gold.MARTS.items():
        same(spark.read.parquet(wh.path("gold", name)), fn(silver, fx.REPLAY_CUTS[-1]))


@pytest.mark.parametrize("where", ["switch_months", "store_watermark", "store_counts"])
def test_a_run_that_dies_is_followed_by_right_marts(spark, scratch, monkeypatch, where):
    """Half a load: Bronze may or may not have changed, the counts are out of step; the next runs put them right."""
    wh = storage.Warehouse(scratch)
    changes = fx.retail_transaction_changes(spark, SF_SMALL)
    cuts = fx.REPLAY_CUTS
    pipeline.build(spark, fx.snapshot_at(changes, cuts[0]), wh, cuts[0])
    real, calls = getattr(storage, where), []

    def dying(*a, **k):
        calls.append(1)
        if len(calls) > (1 if where == "store_watermark" else 0):  # the mark that Gold is out of step is still set
            raise RuntimeError("driver lost")
        return real(*a, **k)

    with monkeypatch.context() as m:
        m.setattr(storage, where, dying)
        with pytest.raises(RuntimeError):
            pipeline.build(spark, fx.snapshot_at(changes, cuts[1]), wh, cuts[1])
    for cut in cuts[1:]:
        pipeline.build(spark, fx.snapshot_at(changes, cut), wh, cut, force=True)
    bronze = storage.read_bronze(spark, wh.path("bronze", pipeline.BRONZE))
    same(bronze.select(*fx.SOURCE_COLUMNS), fx.snapshot_at(changes, cuts[-1]).select(*fx.SOURCE_COLUMNS))
    for name, fn in gold.MARTS.items():
        same(spark.read.parquet(wh.path("gold", name)), fn(silver_cleansed(bronze), cuts[-1]))


def test_row_checks_of_a_clean_load_read_nothing(spark, scratch, monkeypatch):
    from tierwise.operators import quality

    def never(*a, **k):
        raise AssertionError("rows were read again")

    monkeypatch.setattr(quality, "row_checks", never)
    wh = storage.Warehouse(scratch)
    changes = fx.retail_transaction_changes(spark, SF_SMALL)
    for cut in fx.REPLAY_CUTS[:2]:
        report = pipeline.build(spark, fx.snapshot_at(changes, cut), wh, cut)
        assert {r["status"] for r in report.collect()} == {"success"}


def test_counts_of_clean_silver(spark):
    silver = sc.clean_silver(spark, SF_SMALL)
    counts = deltas.roll_up(deltas.finest_counts(sc.clean_bronze(spark, SF_SMALL)))
    assert counts["daily"].agg(F.sum("n_rows")).first()[0] == silver.count()
