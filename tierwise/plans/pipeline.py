"""The hourly build: gate -> Bronze load -> checks -> Silver -> checks -> Gold -> checks (Q9),
stopping at the first layer whose checks fail. Returns a run report (E6) as a DataFrame.

Only scalars reach the driver (watermark, gate answer, months touched, per-check failure counts).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.functions import month_key
from tierwise.operators import deltas, gold, quality
from tierwise.operators.load import (
    bronze_projection,
    has_new_rows,
    incremental_filter,
    months_filter,
    watermark_text,
    with_partition_column,
)
from tierwise.operators.silver import silver_cleansed
from tierwise.plans import storage
from tierwise.schemas import BRONZE_COLUMNS, BRONZE_PARTITION, STATUSES

BRONZE = "bronze_retail_transactions"
SILVER = "silver_retail_transactions_cleansed"


class DataQualityError(RuntimeError):
    """A layer's checks failed; later layers were not built."""

    def __init__(self, layer: str, failed: list[tuple[str, str, str | None, int]]):
        self.layer = layer
        self.failed = failed
        names = ", ".join(f"{m}.{t}({c})={n}" if c else f"{m}.{t}={n}" for m, t, c, n in failed)
        super().__init__(f"data-quality checks failed in {layer}: {names}")


@dataclass
class StepReport:
    model: str
    status: str  # success | failed | skipped | not_run
    rows: int | None = None
    failed_checks: list[str] = field(default_factory=list)
    started: str | None = None
    ended: str | None = None


REPORT_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("rows", T.LongType(), True),
        T.StructField("failed_checks", T.ArrayType(T.StringType()), False),
        T.StructField("started", T.StringType(), True),
        T.StructField("ended", T.StringType(), True),
    ]
)


def _now() -> str:
    return _dt.datetime.now().isoformat(sep=" ", timespec="seconds")


def run_checks(checks: Sequence[quality.Check]) -> list[tuple[str, str, str | None, int]]:
    """Evaluate checks in one job (union of one-row counts); return the failing ones."""
    if not checks:
        return []
    rows = quality.summarise(list(checks)).collect()
    return [(r.model, r.test_name, r.column_name, int(r.failures)) for r in rows if r.failures]


def _later(a: str | None, b: str | None) -> str | None:
    """The later of two watermarks in ``watermark()``'s text form (epoch digits or wall-clock text)."""
    if a is None or b is None:
        return a if b is None else b
    if a.lstrip("-").isdigit() and b.lstrip("-").isdigit():
        return a if int(a) >= int(b) else b
    return max(a, b, key=lambda v: _dt.datetime.fromisoformat(v))


def _gate(spark, source, wh, force) -> tuple[bool, str | None, bool]:
    # a table without a month is empty: load it whole, whatever mark is stored
    exists = bool(storage.bronze_months(spark, wh.path("bronze", BRONZE)))
    wm = storage.read_watermark(spark, wh.state_path(BRONZE)) if exists else None
    return has_new_rows(source, wm, force=force, bronze_exists=exists), wm, exists


def stage_batch(source: DataFrame, wm: str | None, as_of: str, path: str) -> tuple[DataFrame, dict]:
    """The load's rows, written once to the staging folder, and what was seen of them on the way: rows, watermark,
    months."""
    rows = bronze_projection(incremental_filter(source, wm), as_of)
    seen, month = Observation(f"batch-{uuid.uuid4().hex}"), month_key("createdAt")
    notes = [
        F.count(F.lit(1)).alias("n"), watermark_text(rows).alias("wm"),
        F.collect_set(month).alias("months"), F.count_if(month.isNull()).alias("without"),
    ]
    staged = storage.write_staging(rows.observe(seen, *notes), path)
    got = seen.get
    return staged, {"n": got["n"], "wm": got["wm"], "months": [*got["months"], *([None] if got["without"] else [])]}


def build(
    spark: SparkSession,
    source: DataFrame,
    wh: storage.Warehouse,
    as_of: str,
    full_refresh: bool = False,
    force: bool = False,
    fail_fast: bool = True,
    statuses: Sequence[str] = STATUSES,
    key_partition_stable: bool = True,
    check_scope: str = "auto",
    gold_mode: str = "auto",
) -> DataFrame:
    """One run. Raises ``DataQualityError`` at the first failing layer when ``fail_fast``;
    otherwise returns the run report ``(model, status, rows, failed_checks, started, ended)``.

    ``check_scope``: ``full`` checks all of Bronze/Silver; ``incremental`` checks what this load
    rewrote (valid only if the previous run's checks passed); ``auto`` picks incremental exactly
    when the stored state says the previous checks passed and this is not a full refresh.

    ``gold_mode``: ``full`` counts all of Silver again; ``auto`` adds the load's signed changes to the stored
    counts when those are in step with the previous watermark (see ``incremental_gold``), else counts again."""
    from tierwise.plans import incremental_gold as ig

    reports: list[StepReport] = []
    state_path = wh.state_path(BRONZE)
    previous = storage.read_state(spark, state_path) or {}
    go, wm, exists = _gate(spark, source, wh, force or full_refresh)
    if not go:
        reports.append(StepReport("new_data_gate", "skipped", 0, [], _now(), _now()))
        return spark.createDataFrame([tuple(r.__dict__.values()) for r in reports], REPORT_SCHEMA)
    load = int(previous.get("load_number") or 0) + 1

    # --- Bronze -----------------------------------------------------------------------------
    started = _now()
    bronze_path = wh.path("bronze", BRONZE)
    window_wm = None if full_refresh else wm
    staging, changes_path = wh.staging_path(BRONZE), wh.staging_path("changes")
    staged, batch = stage_batch(source, window_wm, as_of, staging)
    existing = None if (full_refresh or not exists) else storage.read_bronze(spark, bronze_path)
    gold_incremental = (
        gold_mode == "auto" and existing is not None and previous.get("gold_wm") is not None and previous.get("gold_wm") == wm
    )
    if gold_incremental:
        # the versions this load replaces, before they are gone. With stable months they lie in the batch's months
        # (a repaired createdAt comes from the NULL month)
        old = existing.filter(months_filter([*batch["months"], None])) if key_partition_stable else existing
        counted = deltas.finest_counts(deltas.signed_changes(old, staged, batch["n"]), silver_cleansed)
    else:  # all of Silver; a first load or a full refresh is its batch
        counted = deltas.finest_counts(staged, silver_cleansed) if existing is None else None
    if previous.get("gold_wm") is not None:  # from here on Gold is out of step until its counts have followed
        keep = {k: previous.get(k) for k in ("load_at", "batch_rows", "checks_passed", "load_number")}
        storage.store_watermark(
            spark, state_path, previous.get("watermark"), keep["load_at"], keep["batch_rows"] or 0, keep["checks_passed"], None,
            keep["load_number"] or 0,
        )
    watch = quality.LayerWatch(silver_cleansed, statuses)
    storage.write_bronze(
        bronze_path, staged.select(*BRONZE_COLUMNS), existing is None, key_partition_stable,
        batch_bytes=storage.folder_bytes(spark, staging), batch_rows=batch["n"], months=batch["months"], watch=watch,
        beside=None if counted is None else lambda: storage.write_staging(counted, changes_path),
    )
    new_wm = _later(None if full_refresh else wm, batch["wm"])
    storage.store_watermark(spark, state_path, new_wm, as_of, batch["n"], None, None, load)  # commit point
    bronze = storage.read_bronze(spark, bronze_path)
    if bronze is None:  # a first load of an empty source
        bronze = with_partition_column(staged)
    silver = silver_cleansed(bronze)
    incremental = check_scope == "incremental" or (
        check_scope == "auto" and not full_refresh and existing is not None and bool(previous.get("checks_passed"))
    )
    # both layers are checked here; Bronze's results gate now, Silver's in its own step below
    failed_by_model: dict[str, list[tuple[str, str, str | None, int]]] = {BRONZE: [], SILVER: []}
    for r in _layer_failures(bronze, staged, batch, watch, incremental or existing is None, incremental, statuses):
        failed_by_model[r.model].append((r.model, r.test_name, r.column_name, int(r.failures)))
    layers_ok = not (failed_by_model[BRONZE] or failed_by_model[SILVER])
    # a red result is recorded so the next run re-checks the whole table instead of only its rows
    storage.store_watermark(spark, state_path, new_wm, as_of, batch["n"], layers_ok, None, load)
    failed = failed_by_model[BRONZE]
    reports.append(StepReport(BRONZE, "failed" if failed else "success", batch["n"], [f"{m}.{t}" for m, t, _, _ in failed], started, _now()))
    if failed and fail_fast:
        raise DataQualityError(BRONZE, failed)

    # --- Silver (a view: nothing written) ------------------------------------------------------
    started = _now()
    silver.createOrReplaceTempView(SILVER)
    failed = failed_by_model[SILVER]
    reports.append(StepReport(SILVER, "failed" if failed else "success", None, [f"{m}.{t}" for m, t, _, _ in failed], started, _now()))
    if failed and fail_fast:
        raise DataQualityError(SILVER, failed)

    # --- Gold: signed counts, and the marts rolled up from them ----------------------------------
    started = _now()
    if counted is None:
        counted = deltas.finest_counts(bronze, silver_cleansed)
        storage.write_staging(counted, changes_path)
    changes = spark.read.schema(counted.schema).parquet(changes_path)
    (ig.add_changes if gold_incremental else ig.rebuild)(spark, wh, changes, load)
    marts = deltas.marts(ig.mart_counts(spark, wh), as_of, bronze.schema["updatedAt"].dataType)
    counts = dict(storage.at_once(spark, [lambda n=n: (n, storage.write_table(marts[n], wh.path("gold", n), n)) for n in marts]))
    written = {name: spark.read.schema(df.schema).parquet(wh.path("gold", name)) for name, df in marts.items()}
    checks = quality.generic_checks(written, statuses, only_gold=True)
    checks += [c for c in quality.singular_checks(written)]
    failed = run_checks(checks)
    ended = _now()
    # Gold is now in step with this watermark
    storage.store_watermark(spark, state_path, new_wm, as_of, batch["n"], layers_ok, new_wm, load)
    storage.delete_path(spark, staging)
    storage.delete_path(spark, changes_path)
    for name in written:
        mine = [f"{m}.{t}" for m, t, _, _ in failed if name in m.split("+")]
        reports.append(StepReport(name, "failed" if mine else "success", counts[name], mine, started, ended))
    if failed and fail_fast:
        raise DataQualityError("gold", failed)
    return spark.createDataFrame([tuple(r.__dict__.values()) for r in reports], REPORT_SCHEMA)


def _layer_failures(bronze, staged, batch, watch, whole: bool, incremental: bool, statuses) -> list:
    """Failing Bronze and Silver checks. The row checks were observed while the months were written; where those are
    all that has to be checked (``whole``) and show nothing wrong, no row is read again for them; Bronze's ids are then
    counted only if some id is twice in Silver."""
    silver = silver_cleansed(bronze, keep=(BRONZE_PARTITION,))

    def failing(unique_in: Sequence[str] | None = None) -> list:
        if incremental:
            rows = quality.incremental_layer_checks(
                bronze, silver, staged, batch["months"], BRONZE, SILVER, statuses, batch_rows=batch["n"], unique_in=unique_in
            )
        elif unique_in is not None:
            rows = quality.unique_ids({m: {BRONZE: bronze, SILVER: silver}[m] for m in unique_in})
        else:
            rows = quality.layer_checks(bronze, silver, BRONZE, SILVER, statuses)
        return [r for r in rows.collect() if r.failures]

    if not (whole and watch.clean):
        return failing()
    # equal ids of Bronze are equal in Silver, which trims them: with no id twice in Silver there is none in Bronze
    found = failing([SILVER])
    return [*failing([BRONZE]), *found] if found else []


def run_hourly(spark: SparkSession, source: DataFrame, wh: storage.Warehouse, as_of: str, **kwargs) -> DataFrame:
    """The hourly entry point: gate, load, checks and marts for one ``as_of`` (see ``build``)."""
    return build(spark, source, wh, as_of, **kwargs)


def register_views(spark: SparkSession, wh: storage.Warehouse) -> list[str]:
    """Ad-hoc SQL over a built warehouse: temp views for Bronze, the Silver view and every written
    mart (``spark.sql("SELECT ... FROM gold_delivery_success_rate")``). Returns the view names."""
    names = []
    bronze_path = wh.path("bronze", BRONZE)
    bronze = storage.read_bronze(spark, bronze_path)
    if bronze is not None:
        bronze.createOrReplaceTempView(BRONZE)
        silver_cleansed(bronze).createOrReplaceTempView(SILVER)
        names += [BRONZE, SILVER]
    for name in gold.MARTS:
        path = wh.path("gold", name)
        if storage.path_exists(spark, path):
            spark.read.parquet(path).createOrReplaceTempView(name)
            names.append(name)
    return names
