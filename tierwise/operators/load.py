"""Bronze loading: projection, high-water mark, incremental batch, new-data gate, keyed upsert and
sort-key (version) dedup.

Only scalars reach the driver: the watermark (one ``max``) and the gate's yes/no (``limit 1``).
The watermark is turned back into a *literal* of the column's own type before it is used, so the
``updatedAt >= wm`` predicate is pushed into the Parquet/JDBC scan instead of running as a join
against a subquery.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.functions import as_of_seconds, month_key, ts_literal, ts_sql
from tierwise.schemas import BRONZE_COLUMNS, BRONZE_PARTITION

WATERMARK_COLUMN = "updatedAt"


def _ts_type(df: DataFrame, col: str) -> T.DataType:
    return df.schema[col].dataType


def _epoch_sql(dt: T.DataType) -> str:
    if isinstance(dt, T.TimestampNTZType):
        return "CAST('1970-01-01 00:00:00' AS TIMESTAMP_NTZ)"
    return "timestamp_seconds(0)"


# --- P1 -----------------------------------------------------------------------------------
def bronze_projection(src: DataFrame, as_of: str) -> DataFrame:
    """Raw copy of the source: 8 columns with their case kept, ``updatedAt`` made non-null
    (NULL -> epoch, so such a row is never inside an incremental window), plus ``load_at`` (the
    run time, whole seconds, same timestamp flavour as the source)."""
    ts_t = _ts_type(src, WATERMARK_COLUMN)
    return src.selectExpr(
        "id",
        "customerId",
        "CAST(lastStatus AS STRING) AS lastStatus",
        "CAST(posOrigin AS STRING) AS posOrigin",
        "CAST(posDestination AS STRING) AS posDestination",
        "createdAt",
        f"coalesce(updatedAt, {_epoch_sql(ts_t)}) AS updatedAt",
        "deletedAt",
        f"{ts_sql(as_of_seconds(as_of), ts_t)} AS load_at",
    )


def with_partition_column(bronze: DataFrame) -> DataFrame:
    """S8: add ``created_month`` (yyyymm of ``createdAt``; NULL rows form their own partition)."""
    return bronze.withColumn(BRONZE_PARTITION, month_key("createdAt"))


# --- S2 -----------------------------------------------------------------------------------
def watermark_df(bronze: DataFrame, col: str = WATERMARK_COLUMN) -> DataFrame:
    """One-row DataFrame ``(watermark)``: ``max(col)``; NULL when Bronze is empty."""
    return bronze.agg(F.max(col).alias("watermark"))


def watermark(bronze: DataFrame | None, col: str = WATERMARK_COLUMN) -> str | None:
    """High-water mark as text that ``ts_literal`` turns back into the exact same value, or
    ``None`` when Bronze is missing or empty. ``None`` means *full load*: comparing ``>= NULL``
    would drop every row.

    ``timestamp_ntz`` gives wall-clock text. A zoned timestamp gives epoch microseconds as digits,
    because wall-clock text is ambiguous in a DST overlap hour and could move the mark forward."""
    if bronze is None:
        return None
    row = bronze.agg(watermark_text(bronze, col).alias("wm")).first()
    return None if row is None else row["wm"]


def watermark_text(bronze: DataFrame, col: str = WATERMARK_COLUMN) -> Column:
    """The aggregate behind ``watermark``."""
    if isinstance(_ts_type(bronze, col), T.TimestampNTZType):
        return F.max(col).cast("string")
    return F.unix_micros(F.max(col)).cast("string")


# --- S3 / S4 -------------------------------------------------------------------------------
def incremental_filter(src: DataFrame, wm: str | None, col: str = WATERMARK_COLUMN) -> DataFrame:
    """Rows with ``col >= wm`` (inclusive on purpose: rows committed in the same microsecond as the
    watermark are re-read; the upsert makes that harmless). ``wm is None`` -> every row (S4)."""
    if wm is None:
        return src
    return src.filter(F.col(col) >= ts_literal(wm, _ts_type(src, col)))


# --- S5 -------------------------------------------------------------------------------------
def has_new_rows(
    src: DataFrame,
    wm: str | None,
    col: str = WATERMARK_COLUMN,
    force: bool = False,
    bronze_exists: bool = True,
) -> bool:
    """Gate: run the load only if forced, Bronze is missing or empty, or some source row is
    strictly newer than the watermark (``>``; ``>=`` would never skip). ``limit(1)`` stops the scan
    at the first hit."""
    if force or not bronze_exists or wm is None:
        return True
    probe = src.filter(F.col(col) > ts_literal(wm, _ts_type(src, col))).select(col).limit(1)
    return len(probe.take(1)) > 0


def new_data_gate_df(src: DataFrame, wm: str | None, col: str = WATERMARK_COLUMN) -> DataFrame:
    """The gate as a one-row DataFrame ``(has_new_rows int)`` computed on the cluster."""
    if wm is None:
        return src.sparkSession.range(1).select(F.lit(1).alias("has_new_rows"))
    hits = src.filter(F.col(col) > ts_literal(wm, _ts_type(src, col))).select(F.lit(1).alias("x")).limit(1)
    return hits.agg(F.count("x").cast("int").alias("has_new_rows"))


# --- S6 -------------------------------------------------------------------------------------
def latest_per_key(
    df: DataFrame, key: Sequence[str], order: Sequence[str], payload: Sequence[str] | None = None
) -> DataFrame:
    """One row per ``key``: the row with the greatest ``order`` tuple.

    ``groupBy(key).agg(max(struct(order..., payload...)))`` — an aggregate, so rows are reduced
    per partition before the shuffle (a hot key sends one partial row per task, not all its rows)
    and ties resolve deterministically by the remaining struct fields."""
    key = list(key)
    order = list(order)
    payload = [c for c in (payload or df.columns) if c not in key and c not in order]
    packed = df.groupBy(*key).agg(F.max(F.struct(*order, *payload)).alias("_v"))
    return packed.select(*key, *[F.col(f"_v.{c}").alias(c) for c in order + payload]).select(*df.columns)


def upsert_by_key(
    existing: DataFrame,
    batch: DataFrame,
    key: str | Sequence[str] = "id",
    batch_keys: DataFrame | None = None,
) -> DataFrame:
    """Delete + insert by key: existing rows whose key is in the batch are dropped, the batch is
    appended; the batch always wins (even if older). Soft-deleted rows are ordinary rows here.

    ``left_anti`` against the batch keys. Pass ``batch_keys`` (e.g. a size-checked broadcast of
    them) to control the join; otherwise AQE broadcasts them when they prove small at run time and
    shuffles (skew-split) when not."""
    keys = [key] if isinstance(key, str) else list(key)
    batch = batch.select(*existing.columns)
    # no distinct() on the keys: an anti join is unaffected by duplicate keys, and skipping it
    # saves a shuffle of the batch
    kept = existing.join(batch_keys if batch_keys is not None else batch.select(*keys), keys, "left_anti")
    return kept.unionByName(batch)


# --- S7 -------------------------------------------------------------------------------------
def dedup_versions(
    df: DataFrame,
    sort_key: Sequence[Column | str],
    version: str = WATERMARK_COLUMN,
    partition: Sequence[Column | str] | None = None,
    tiebreak: Sequence[str] = ("load_at",),
) -> DataFrame:
    """Replacing-merge read (``FINAL``): within each partition, rows equal on the sort key collapse
    to the one with the greatest ``version``; ties go to the latest arrival (``tiebreak``).

    Sort-key items may be expressions (e.g. ``to_date(updatedAt)``); they are materialised as
    hidden columns, grouped on, then dropped; columns given by name are grouped on as they are and
    not carried a second time. A max-struct aggregate, not a window, so duplicate versions are
    collapsed map-side before the shuffle."""
    order = [version] + [c for c in tiebreak if c in df.columns and c != version]
    keys = []
    tmp = df
    for i, item in enumerate(list(partition or []) + list(sort_key)):
        if isinstance(item, str) and item in df.columns and item not in (*order, *keys):
            keys.append(item)
            continue
        name = f"_dk{i}"
        tmp = tmp.withColumn(name, F.col(item) if isinstance(item, str) else item)
        keys.append(name)
    out = latest_per_key(tmp, keys, order, payload=[c for c in df.columns])
    return out.select(*df.columns)


def bronze_sort_key() -> list[Column | str]:
    """Bronze physical sort key: ``(toDate(updatedAt), lastStatus, id)``."""
    return [F.to_date(F.col("updatedAt")), "lastStatus", "id"]


# --- one load step ---------------------------------------------------------------------------
def load_batch(src: DataFrame, wm: str | None, as_of: str) -> DataFrame:
    """The rows a run lands in Bronze: projection of the incremental (or full) window."""
    return bronze_projection(incremental_filter(src, wm), as_of)


def apply_load(existing: DataFrame | None, src: DataFrame, as_of: str) -> tuple[DataFrame, DataFrame, str | None]:
    """Watermark from ``existing`` -> batch -> upsert. Returns ``(new_bronze, batch, watermark)``."""
    wm = watermark(existing)
    batch = load_batch(src, wm, as_of)
    if existing is None:
        return batch, batch, wm
    return upsert_by_key(existing.select(*BRONZE_COLUMNS), batch, "id"), batch, wm


def months_filter(months: Sequence[int | None], col: str = BRONZE_PARTITION) -> Column:
    """Predicate selecting the given ``created_month`` values (``None`` = the NULL-month partition).
    A plain ``IN`` on the partition column, so Parquet partition pruning applies."""
    known = [int(m) for m in months if m is not None]
    cond = F.col(col).isin(*known) if known else F.lit(False)
    return cond | F.col(col).isNull() if any(m is None for m in months) else cond


def touched_months(batch: DataFrame) -> list[int | None]:
    """The ``created_month`` values of a batch: a handful of scalars (bounded by the calendar)."""
    return [r[0] for r in with_partition_column(batch).select(BRONZE_PARTITION).distinct().collect()]


# --- S15 ------------------------------------------------------------------------------------
def drop_months(bronze: DataFrame, months: Sequence[int]) -> DataFrame:
    """Retention by whole months: rows of the given ``created_month`` values removed (a partition
    filter, so on a month-partitioned table the dropped months are never even listed)."""
    return bronze.filter(~F.col(BRONZE_PARTITION).isin(*[int(m) for m in months]) | F.col(BRONZE_PARTITION).isNull())


def retain_from_month(bronze: DataFrame, first_month: int) -> DataFrame:
    """Keep months ``>= first_month`` (and the NULL-month partition)."""
    return bronze.filter((F.col(BRONZE_PARTITION) >= F.lit(int(first_month))) | F.col(BRONZE_PARTITION).isNull())
