"""E5: streaming upsert is correct with several micro-batches, replays and out-of-order files."""

import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tierwise.plans import storage
from tierwise.schemas import BRONZE_COLUMNS
from tierwise.sources import fixtures as fx
from tierwise.streaming.stream_upsert import bronze_stream_upsert


def run(spark, base, schema):
    q = bronze_stream_upsert(spark, f"{base}/input", schema, f"{base}/bronze", f"{base}/_ckpt", fx.AS_OF, ("updatedAt", "version"), 2)
    q.awaitTermination()
    return storage.read_bronze(spark, f"{base}/bronze").select(*BRONZE_COLUMNS)


def test_stream_newest_wins_even_out_of_order(spark, scratch):
    base = f"{scratch}/{uuid.uuid4().hex}"
    changes = fx.retail_transaction_changes(spark, SF_SMALL)
    for j in (5, 3, 1, 0, 4, 2):  # newest versions first
        changes.filter(F.col("version") == j).write.mode("append").parquet(f"{base}/input")
    schema = spark.read.parquet(f"{base}/input").schema
    got = run(spark, base, schema)
    expect = fx.snapshot_at(changes, fx.AS_OF)
    assert got.count() == expect.count() == got.select("id").distinct().count()
    assert got.drop("load_at").exceptAll(expect).count() == 0
    first = sorted(map(tuple, got.collect()))  # collect now: the next run replaces the files
    # older versions arriving again (a replay) change nothing
    changes.filter(F.col("version") == 0).write.mode("append").parquet(f"{base}/input")
    again = sorted(map(tuple, run(spark, base, schema).collect()))
    assert again == first


def counted(monkeypatch):
    calls, real = [], storage.switch_months

    def counting(spark, path, folder, written, replaced):
        calls.append(sorted(written, key=str))
        return real(spark, path, folder, written, replaced)

    monkeypatch.setattr(storage, "switch_months", counting)
    return calls


def test_replays_and_stale_files_rewrite_no_month(spark, scratch, monkeypatch):
    base = f"{scratch}/{uuid.uuid4().hex}"
    changes = fx.retail_transaction_changes(spark, SF_SMALL)
    newest = fx.snapshot_at(changes, fx.AS_OF)
    late = changes.filter(F.col("version") == 0).join(newest.select("id", F.col("updatedAt").alias("u")), "id").where("updatedAt < u").drop("u")
    changes.filter(F.col("version") > 0).write.parquet(f"{base}/input")
    schema = spark.read.parquet(f"{base}/input").schema
    calls = counted(monkeypatch)
    first = sorted(map(tuple, run(spark, base, schema).collect()), key=str)
    rewrites = len(calls)
    assert rewrites >= 1
    changes.filter(F.col("version") == 1).write.mode("append").parquet(f"{base}/input")  # a replay: falls in the stream
    late.join(changes.filter("version > 0").select("id").distinct(), "id").select(*changes.columns).write.mode("append").parquet(f"{base}/input")  # older than Bronze
    assert sorted(map(tuple, run(spark, base, schema).collect()), key=str) == first
    assert len(calls) == rewrites


def test_only_months_with_newer_rows_are_rewritten(spark, scratch, monkeypatch):
    from conftest import src_df
    from tierwise.operators.load import bronze_projection

    path, t = f"{scratch}/bronze", "2025-03-01 00:00:00"

    def rows(*r):
        return bronze_projection(src_df(spark, [(i, "c", s, "X", "Y", made, at, None) for i, s, made, at in r]), t)

    jan, feb = "2025-01-05 00:00:00", "2025-02-05 00:00:00"
    storage.write_bronze(path, rows(("a", "PROCESSING", jan, jan), ("b", "BOOKED", feb, feb)), newer_wins=True)
    calls = counted(monkeypatch)
    storage.write_bronze(path, rows(("a", "BOOKED", jan, jan), ("b", "PROCESSING", feb, "2025-02-06 00:00:00")), newer_wins=True)
    assert calls == [[202502]]
    assert {r["id"]: r["lastStatus"] for r in storage.read_bronze(spark, path).collect()} == {"a": "PROCESSING", "b": "PROCESSING"}


def test_state_forgets_no_row_that_is_new(spark, scratch):
    """Versions that differ in any version column all pass; exact repeats in one file are one."""
    rows = [("a", "BOOKED", 1), ("a", "BOOKED", 2), ("a", "PROCESSING", 2), ("a", "PROCESSING", 2), (None, None, 1), (None, None, 1)]
    df = spark.createDataFrame(rows, "id string, lastStatus string, d int").selectExpr(
        "id", "lastStatus", "date_add(DATE '2025-01-01', d)::timestamp_ntz AS updatedAt", "CAST(NULL AS timestamp_ntz) AS deletedAt"
    )
    df.write.parquet(f"{scratch}/in")
    stream = spark.readStream.schema("id string, lastStatus string, updatedAt timestamp_ntz, deletedAt timestamp_ntz").parquet(f"{scratch}/in")
    from tierwise.streaming.stream_upsert import without_replays

    q = without_replays(stream, 1).writeStream.format("memory").queryName("passed").option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("passed").count() == 4


PROVIDER = "spark.sql.streaming.stateStore.providerClass"
IN_MEMORY = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def fed(spark, base, rows, **options):
    """The stream after one more file of ``rows`` (id, status, hour of the update); returns its state's progress in
    the micro-batch of the file and in the one without rows that follows."""
    df = spark.createDataFrame(rows, "id string, lastStatus string, h int").selectExpr(
        "id", "'c' AS customerId", "lastStatus", "'X' AS posOrigin", "'Y' AS posDestination", "TIMESTAMP_NTZ '2025-01-05' AS createdAt",
        "timestampadd(HOUR, h, TIMESTAMP_NTZ '2025-01-05') AS updatedAt", "CAST(NULL AS TIMESTAMP_NTZ) AS deletedAt",
    )
    df.coalesce(1).write.mode("append").parquet(f"{base}/in")
    q = bronze_stream_upsert(spark, f"{base}/in", df.schema, f"{base}/bronze", f"{base}/_ckpt", fx.AS_OF, **options)
    q.awaitTermination()
    return [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]


def stored(spark, base):
    return {r["id"]: r["lastStatus"] for r in storage.read_bronze(spark, f"{base}/bronze").collect()}


def test_state_lies_on_disk_within_a_memory_shared_by_its_partitions(spark, scratch):
    from tierwise.streaming.stream_upsert import STREAM_SETTINGS

    before = {k: spark.conf.get(k, None) for k in STREAM_SETTINGS}
    state, _ = fed(spark, scratch, [("a", "BOOKED", 0), ("a", "PROCESSING", 1), ("b", "BOOKED", 0), (None, "BOOKED", 0)])
    assert state["customMetrics"]["rocksdbPutCount"] == 4
    assert {k: spark.conf.get(k, None) for k in STREAM_SETTINGS} == before
    state, _ = fed(spark, scratch, [("a", "PROCESSING", 1), ("b", "PROCESSING", 2)])  # a replay, and a new version
    assert state["numRowsUpdated"] == 1
    assert stored(spark, scratch) == {"a": "PROCESSING", "b": "PROCESSING", None: "BOOKED"}


def test_expired_versions_are_forgotten(spark, scratch):
    _, after = fed(spark, scratch, [("a", "BOOKED", 0), ("b", "BOOKED", 0)], replay_hours=0)
    assert after["numRowsRemoved"] == 2
    state, _ = fed(spark, scratch, [("a", "BOOKED", 0)], replay_hours=0)
    assert state["numRowsUpdated"] == 1  # it passes again
    assert stored(spark, scratch) == {"a": "BOOKED", "b": "BOOKED"}


def test_a_checkpoint_with_state_in_memory_goes_on(spark, scratch):
    spark.conf.set(PROVIDER, IN_MEMORY)
    try:
        state = fed(spark, scratch, [("a", "BOOKED", 0), ("b", "BOOKED", 0)])[0]
    finally:
        spark.conf.unset(PROVIDER)
    assert not any(k.startswith("rocksdb") for k in state["customMetrics"])
    state, _ = fed(spark, scratch, [("a", "BOOKED", 0), ("b", "PROCESSING", 1)])
    assert state["numRowsUpdated"] == 1
    assert stored(spark, scratch) == {"a": "BOOKED", "b": "PROCESSING"}
