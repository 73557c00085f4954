
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierwise.operators import gold
from tierwise.plans import scenarios as sc
from tierwise.sources.fixtures import AS_OF

Query = Callable[[SparkSession, str], DataFrame]


def q_source_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1: the operational table, an export of the source read with its fixed schema."""
    from tierwise.sources.source import read_source

    return read_source(spark, sc.source_files(spark, sf_dir))


def q_bronze_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sc.dirty_bronze(spark, sf_dir)


def q_silver_cleansed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sc.dirty_silver(spark, sf_dir)


def _mart(name: str) -> Query:
    fn = gold.MARTS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(sc.clean_silver(spark, sf_dir), AS_OF)

    run.__name__ = f"q_{name}"
    return run


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "source_scan": q_source_scan,
        "bronze_projection": q_bronze_projection,
        "silver_cleansed": q_silver_cleansed,
    }
    for name in gold.MARTS:
        q[name] = _mart(name)
    q.update(_MORE)
    return q


# --- loads (S2-S7, S15, S17) over four replayed incremental loads ---------------------------
from pyspark.sql import functions as F  # noqa: E402

from tierwise.functions import ts_literal  # noqa: E402
from tierwise.operators import load, quality, reconcile  # noqa: E402
from tierwise.operators.silver import silver_cleansed  # noqa: E402
from tierwise.schemas import BRONZE_PARTITION, STATUSES  # noqa: E402
from tierwise.sources import fixtures as fx  # noqa: E402


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_bronze_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watermark after each load: ``(load_number, load_at, watermark)``."""
    rep = sc.replay(spark, sf_dir)
    return _union(
        [
            load.watermark_df(state).select(
                F.lit(i + 1).cast("int").alias("load_number"),
                ts_literal(cut).alias("load_at"),
                "watermark",
            )
            for i, (state, cut) in enumerate(zip(rep.states, fx.REPLAY_CUTS))
        ]
    )


def q_bronze_incremental_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the last load lands: the source's export with ``updatedAt >= watermark`` pushed into its scan."""
    from tierwise.sources.source import read_source

    rep = sc.replay(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/source-{uuid.uuid4().hex}"
    rep.sources[-1].repartitionByRange("updatedAt").sortWithinPartitions("updatedAt").write.parquet(path)
    return load.load_batch(read_source(spark, path), rep.watermarks[-1], fx.REPLAY_CUTS[-1])


def q_bronze_full_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First load (no watermark): the whole source, with its month partition column."""
    return load.with_partition_column(load.load_batch(sc.clean_source(spark, sf_dir), None, AS_OF))


def q_new_data_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gate before each load, plus a 5th check after the last load (nothing newer -> 0)."""
    rep = sc.replay(spark, sf_dir)
    parts = [
        load.new_data_gate_df(src, wm).select(F.lit(i + 1).cast("int").alias("load_number"), "has_new_rows")
        for i, (src, wm) in enumerate(zip(rep.sources, rep.watermarks))
    ]
    final_wm = load.watermark(rep.states[-1])
    parts.append(
        load.new_data_gate_df(rep.sources[-1], final_wm).select(
            F.lit(len(rep.sources) + 1).cast("int").alias("load_number"), "has_new_rows"
        )
    )
    return _union(parts)


def q_bronze_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One upsert: Bronze = full load of the source as at the third cut; batch = the current
    source past that Bronze's watermark."""
    from tierwise.session import cut_lineage

    cut = fx.REPLAY_CUTS[2]
    changes = fx.retail_transaction_changes(spark, sf_dir, AS_OF)
    # the existing Bronze is a written table in a real run: materialise it once (its watermark is
    # read first, then it is anti-joined), instead of deriving it twice from the change feed
    existing = cut_lineage(load.bronze_projection(fx.snapshot_at(changes, cut), cut))
    new, _, _ = load.apply_load(existing, sc.clean_source(spark, sf_dir), AS_OF)
    return new


def q_versioned_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replacing-merge read of the appended batches: one row per (month, day, status, id)."""
    log = sc.appended_log(sc.replay(spark, sf_dir))
    return load.dedup_versions(
        log, load.bronze_sort_key(), "updatedAt", partition=[BRONZE_PARTITION], tiebreak=("load_at",)
    )


RETAIN_FROM_MONTH = 199601


def q_drop_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention on the stored Bronze: the partitions before ``RETAIN_FROM_MONTH`` are dropped."""
    from tierwise.plans import storage

    path = sc.stored_bronze(spark, sf_dir)
    old = [m for m in storage.bronze_months(spark, path) if m is not None and m < RETAIN_FROM_MONTH]
    storage.drop_month_partitions(spark, path, old)
    return storage.read_bronze(spark, path)


def q_soft_delete_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver over the written Bronze after four builds: soft-deleted rows present and flagged, one
    row per id."""
    from tierwise.plans import pipeline, storage

    for _, wh, _ in sc.shipped_loads(spark, sf_dir):
        pass
    return silver_cleansed(storage.read_bronze(spark, wh.path("bronze", pipeline.BRONZE)))


def _build(bronze: DataFrame) -> dict[str, DataFrame]:
    """All layers of one build. The five marts roll up from one pre-aggregate of Silver, which is
    materialised once (reliable checkpoint in the shared checkpoint folder; it is small: days x
    statuses x routes x 2). Without that, column pruning gives every mart a different cube
    aggregate, the exchanges stop being identical and each mart would rescan Bronze."""
    from tierwise.session import cut_lineage

    silver = silver_cleansed(bronze)
    out = {"bronze_retail_transactions": bronze, "silver_retail_transactions_cleansed": silver}
    out.update(gold.marts_from_cube(cut_lineage(gold.mart_cube(silver, AS_OF)), AS_OF))
    return out


def _clean_build(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _build(sc.clean_bronze(spark, sf_dir))


def _dirty_build(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _build(sc.dirty_bronze(spark, sf_dir))


def q_layer_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _clean_build(spark, sf_dir)
    layer = {"bronze_retail_transactions": "bronze", "silver_retail_transactions_cleansed": "silver"}
    return reconcile.layer_inventory({n: (layer.get(n, "gold"), df) for n, df in b.items()})


# --- reports and reconciliation (O2, O3, V1-V4) ------------------------------------------------
def q_top_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.top_routes(gold.gold_delivery_success_rate(sc.clean_silver(spark, sf_dir), AS_OF), 4)


def q_recent_soft_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.recent_soft_deletes(sc.clean_silver(spark, sf_dir), 10)


def q_bronze_duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids present more than once after a ``FINAL`` (sort-key dedup) read: the upserted Bronze
    (expected 0) next to a plain append of the same batches (sort-key dedup does not make ids
    unique, because the key includes day and status)."""
    rep = sc.replay(spark, sf_dir)
    sk = load.bronze_sort_key()

    def final_read(df: DataFrame) -> DataFrame:
        return load.dedup_versions(load.with_partition_column(df), sk, partition=[BRONZE_PARTITION])

    upserted = reconcile.duplicate_id_count(final_read(rep.states[-1]))
    appended = reconcile.duplicate_id_count(
        load.dedup_versions(sc.appended_log(rep), sk, partition=[BRONZE_PARTITION])
    )
    return upserted.select(F.lit("bronze_retail_transactions").alias("table_name"), "duplicate_ids").unionByName(
        appended.select(F.lit("append_only_log").alias("table_name"), "duplicate_ids")
    )


def q_cross_mart_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _clean_build(spark, sf_dir)
    return reconcile.cross_mart_consistency(b["gold_daily_transaction_valid"], b["gold_daily_transaction_comprehensive"])


def q_cancelled_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _clean_build(spark, sf_dir)
    return reconcile.cancelled_reconciliation(
        b["gold_daily_transaction_comprehensive"], b["silver_retail_transactions_cleansed"]
    )


def q_soft_delete_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _clean_build(spark, sf_dir)
    return reconcile.soft_delete_reconciliation(
        b["gold_daily_transaction_comprehensive"], b["silver_retail_transactions_cleansed"]
    )


# --- data quality (Q1-Q8) on planted violations ------------------------------------------------
def q_dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_unique(sc.dirty_bronze(spark, sf_dir), "id")


def q_dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = sc.dirty_silver(spark, sf_dir)
    return quality.null_counts(silver, silver.columns)


def q_dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_accepted_values(sc.dirty_bronze(spark, sf_dir), "lastStatus", STATUSES)


def q_dq_is_deleted_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_is_deleted_consistent(fx.plant_flag_flips(sc.clean_silver(spark, sf_dir)))


def q_dq_daily_grain_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _clean_build(spark, sf_dir)
    v, c = fx.plant_grain_duplicates(b["gold_daily_transaction_valid"], b["gold_daily_transaction_comprehensive"])
    return quality.dq_daily_grain_unique(v, c)


def q_dq_route_lead_time_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_route_lead_time_valid(
        gold.gold_route_performance_metrics(sc.dirty_silver(spark, sf_dir), AS_OF)
    )


def q_dq_success_rate_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_success_rate_bounds(
        fx.plant_rates(gold.gold_delivery_success_rate(sc.clean_silver(spark, sf_dir), AS_OF))
    )


def q_dq_suite_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite over the dirty build, with planted wrong flags in Silver (which Bronze cannot show)."""
    layers = _dirty_build(spark, sf_dir)
    silver = "silver_retail_transactions_cleansed"
    return quality.dq_suite_summary(layers | {silver: fx.plant_flag_flips(layers[silver])}, STATUSES)


_MORE: dict[str, Query] = {
    "bronze_watermark": q_bronze_watermark,
    "bronze_incremental_batch": q_bronze_incremental_batch,
    "bronze_full_load": q_bronze_full_load,
    "new_data_gate": q_new_data_gate,
    "bronze_upsert": q_bronze_upsert,
    "versioned_dedup": q_versioned_dedup,
    "drop_month": q_drop_month,
    "layer_inventory": q_layer_inventory,
    "soft_delete_sync": q_soft_delete_sync,
    "top_routes": q_top_routes,
    "recent_soft_deletes": q_recent_soft_deletes,
    "bronze_duplicate_ids": q_bronze_duplicate_ids,
    "cross_mart_consistency": q_cross_mart_consistency,
    "cancelled_reconciliation": q_cancelled_reconciliation,
    "soft_delete_reconciliation": q_soft_delete_reconciliation,
    "dq_unique": q_dq_unique,
    "dq_not_null": q_dq_not_null,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_is_deleted_consistent": q_dq_is_deleted_consistent,
    "dq_daily_grain_unique": q_dq_daily_grain_unique,
    "dq_route_lead_time_valid": q_dq_route_lead_time_valid,
    "dq_success_rate_bounds": q_dq_success_rate_bounds,
    "dq_suite_summary": q_dq_suite_summary,
}


# --- marts by signed counts ----------------------------------------------------------------------
from tierwise.operators import deltas  # noqa: E402


def q_route_metrics_after_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 after a load that soft-deletes the fastest parcels of every route: the stored lead-hour counts and the load's
    signed counts; no other parcel is looked at."""
    bronze, batch = sc.after_fastest_deleted(spark, sf_dir)
    base = deltas.roll_up(deltas.finest_counts(bronze))["lead"]
    change = deltas.roll_up(deltas.finest_counts(deltas.signed_changes(bronze, batch)))["lead"]
    return deltas.route_performance(deltas.merged("lead", base, change), AS_OF)


def _active(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tierwise.session import cut_lineage

    return cut_lineage(deltas.roll_up(deltas.finest_counts(sc.clean_bronze(spark, sf_dir)))["active"])


def q_aging_alerts_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 at several times, all from one table of counts by (status, route, hour of the last update)."""
    active = _active(spark, sf_dir)
    return _union([deltas.aging_alerts(active, as_of) for as_of in fx.AGING_TIMES])


def q_aging_sla_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4 from the same counts, with thresholds by route."""
    silver = sc.clean_silver(spark, sf_dir)
    sla = ext.route_sla_from_performance(gold.gold_route_performance_metrics(silver, AS_OF))
    return deltas.aging_alerts_by_sla(_active(spark, sf_dir), sla, AS_OF)


_MORE.update(
    {
        "route_metrics_after_deletes": q_route_metrics_after_deletes,
        "aging_alerts_by_hour": q_aging_alerts_by_hour,
        "aging_sla_by_hour": q_aging_sla_by_hour,
    }
)


# --- extensions (E1-E6) -------------------------------------------------------------------------
import uuid  # noqa: E402

from tierwise.operators import extensions as ext  # noqa: E402
from tierwise.session import checkpoint_dir  # noqa: E402


def q_status_transition_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ext.status_transition_audit(fx.changes_with_illegal_moves(spark, sf_dir, AS_OF))


def q_hard_delete_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ext.hard_delete_reconciliation(sc.clean_bronze(spark, sf_dir), fx.source_with_hard_deletes(spark, sf_dir))


def q_incremental_daily_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comprehensive daily mart after a fourth load on top of three builds: the stored counts and the signed counts
    of the batch and of the versions that it replaces; rows of dates that the load does not touch stay as they are."""
    from tierwise.plans import incremental_gold as ig
    from tierwise.plans import pipeline, storage

    for _, wh, _ in sc.shipped_loads(spark, sf_dir, fx.REPLAY_CUTS[:-1]):
        pass
    cut, path = fx.REPLAY_CUTS[-1], wh.path("bronze", pipeline.BRONZE)
    source = fx.snapshot_at(fx.retail_transaction_changes(spark, sf_dir, AS_OF), cut)
    batch = load.load_batch(source, storage.read_watermark(spark, wh.state_path(pipeline.BRONZE)), cut)
    batch = storage.write_staging(batch, wh.staging_path("batch"))
    old = storage.read_bronze(spark, path).filter(load.months_filter([*load.touched_months(batch), None]))
    changes = storage.write_staging(deltas.signed_changes(old, batch), wh.staging_path("changes"))
    mart = spark.read.parquet(wh.path("gold", "gold_daily_transaction_comprehensive"))
    return deltas.daily_mart_after(mart, storage.read_counts(spark, ig.counts_path(wh, "daily")), changes, cut)


def q_aging_with_route_sla(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = sc.clean_silver(spark, sf_dir)
    sla = ext.route_sla_from_performance(gold.gold_route_performance_metrics(silver, AS_OF))
    return ext.aging_with_route_sla(silver, sla, AS_OF)


def q_bronze_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream every version of the change feed into Bronze; the end state is the source as of ``AS_OF``."""
    from tierwise.streaming.stream_upsert import bronze_stream_upsert

    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    changes = fx.retail_transaction_changes(spark, sf_dir, AS_OF)
    changes.write.parquet(f"{base}/input")
    schema = spark.read.parquet(f"{base}/input").schema
    q = bronze_stream_upsert(
        spark, f"{base}/input", schema, f"{base}/bronze", f"{base}/_checkpoint", AS_OF, ("updatedAt", "version")
    )
    q.awaitTermination()
    from tierwise.plans import storage

    return storage.read_bronze(spark, f"{base}/bronze").select(*load.BRONZE_COLUMNS)


def q_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6: report of the last of four builds of the shipped path. The registered query keeps the
    deterministic columns; the pipeline's report also has ``started`` and ``ended`` wall-clock times."""
    for _, _, rep in sc.shipped_loads(spark, sf_dir):
        pass
    return rep.select("model", "status", "rows", F.concat_ws(",", "failed_checks").alias("failed_checks"))


_MORE.update(
    {
        "status_transition_audit": q_status_transition_audit,
        "hard_delete_reconciliation": q_hard_delete_reconciliation,
        "incremental_daily_mart": q_incremental_daily_mart,
        "aging_with_route_sla": q_aging_with_route_sla,
        "bronze_stream_upsert": q_bronze_stream_upsert,
        "run_report": q_run_report,
    }
)
