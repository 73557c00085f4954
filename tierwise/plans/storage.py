"""Physical layout of the warehouse: tables of Spark's catalog over Parquet (S8, S9, S12-S15) and the load state.

* Bronze is a catalog table partitioned by ``created_month``, each month sorted by
  ``(to_date(updatedAt), lastStatus, id)`` so Parquet min/max statistics skip row groups.
* A load writes the months it touches to a new folder and then points the partitions there:
  ``ALTER TABLE ... ADD PARTITION`` for new months, ``PARTITION ... SET LOCATION`` for rewritten ones, ``DROP
  PARTITION`` for emptied ones, in this order. No file is replaced, so a month is always whole, old or new. A run
  that dies between two statements has not moved the watermark; the next run reads the same window and the
  keyed upsert makes that harmless. Folders that a switch left behind are removed by the next one.
* The load state (watermark, result of the checks, what Gold is in step with) is one table property, set by one
  statement after the months are switched.
* Gold marts are fully rebuilt (overwrite) and written range-partitioned and sorted by their configured order.
* Names: a table is ``<schema folder>_<hash of its folder>.<table folder>``, so warehouses under different roots
  share a catalog. On a cluster the catalog must outlive the session (a metastore); a session that does not know
  the table loads it whole again.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from tierwise.operators.load import (
    months_filter,
    touched_months,
    upsert_by_key,
    with_partition_column,
)
from tierwise.schemas import BRONZE_COLUMNS, BRONZE_PARTITION, STATUSES, WRITE_ORDER


# --- S14 ------------------------------------------------------------------------------------
def layer_name(target: str, default_schema: str, custom: str | None) -> str:
    """Schema (folder) name of a layer: in ``prod`` the bare custom name; elsewhere
    ``<default>_<custom>``; without a custom name the default."""
    if custom is None:
        return default_schema
    custom = custom.strip()
    return custom if target == "prod" else f"{default_schema}_{custom}"


LAYER_SCHEMAS = {"bronze": "bronze_lake", "silver": "silver_lake", "gold": "gold_lake"}


@dataclass(frozen=True)
class Warehouse:
    """Folder layout ``<root>/<schema>/<table>`` for one target (``prod``, ``dev`` ...)."""

    root: str
    target: str = "prod"
    default_schema: str = "warehouse"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer_name(self.target, self.default_schema, LAYER_SCHEMAS[layer])}/{table}"

    def state_path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/_state/{table}"

    def staging_path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/_staging/{table}/{uuid.uuid4().hex}"


# --- helpers ----------------------------------------------------------------------------------
def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_fs(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below ``path`` (0 if it is not there)."""
    fs, p = _hadoop_fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


# --- catalog -------------------------------------------------------------------------------------
def catalog_name(path: str) -> str:
    """``database.table`` of the table kept at ``path``."""
    schema, table = path.rstrip("/").rsplit("/", 2)[-2:]
    database = re.sub(r"\W", "_", f"{schema}_{zlib.crc32(path.rstrip('/').encode()):08x}")
    return f"`{database}`.`{table}`"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_table(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> str:
    """The managed Parquet table at ``path`` (created if the catalog does not have it); returns its name."""
    name = catalog_name(path)
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]} LOCATION {_quoted(path.rstrip('/').rsplit('/', 1)[0])}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{parts}")
    return name


def table_property(spark: SparkSession, path: str, key: str):
    """The JSON value of a property of the table at ``path``; ``None`` without the table or the property."""
    name = catalog_name(path)
    if not spark.catalog.tableExists(name):
        return None
    value = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}.get(key)
    return None if value is None else json.loads(value)


def set_table_property(spark: SparkSession, path: str, key: str, value) -> None:
    spark.sql(f"ALTER TABLE {catalog_name(path)} SET TBLPROPERTIES ({_quoted(key)} = {_quoted(json.dumps(value))})")


# --- S9 / S12 ----------------------------------------------------------------------------------
def _order_columns(order: Sequence[str]) -> list[Column]:
    cols = []
    for c in order:
        cols.append(F.to_date(F.col("updatedAt")) if c == "updated_date" else F.col(c))
    return cols


TARGET_PARTITION_BYTES = 256 << 20


def sorted_for_write(
    df: DataFrame,
    order: Sequence[str],
    partition_by: Sequence[str] = (),
    size_bytes: int | None = None,
    observed: Callable[[DataFrame], DataFrame] | None = None,
    least: int = 1,
) -> DataFrame:
    """Range-partition on ``(partition_by..., order...)`` and sort within partitions: every task
    writes a contiguous key range (tight min/max per file), and a hot partition value is split
    across tasks by the secondary keys instead of landing in one task. ``size_bytes``, the size of
    what is read for the write, sets the number of partitions (``least`` or more); without it the session does.
    ``observed`` is handed the rows after the exchange (what is before it runs once more for the range
    bounds) and before the sort (which must be the last step before the write)."""
    keys = [F.col(c) for c in partition_by] + _order_columns(order)
    ranged = df.repartitionByRange(*([] if size_bytes is None else [max(least, -(-size_bytes // TARGET_PARTITION_BYTES))]), *keys)
    return (observed(ranged) if observed else ranged).sortWithinPartitions(*keys)


def write_table(df: DataFrame, path: str, table: str) -> int:
    """S12: full rebuild (overwrite) of a mart, sorted by its configured order; returns its rows."""
    order = WRITE_ORDER.get(table, ())
    seen = Observation(f"mart-{uuid.uuid4().hex}")

    def counted(rows: DataFrame) -> DataFrame:
        return rows.observe(seen, F.count(F.lit(1)).alias("n"))

    out = sorted_for_write(df, order, observed=counted) if order else counted(df)
    out.write.mode("overwrite").parquet(path)
    return seen.get["n"]


def write_staging(df: DataFrame, path: str) -> DataFrame:
    """Write a batch to the shared staging folder and read it back: the load then works on a fixed
    snapshot (a mutable source read twice could differ) and lineage is cut."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- S8 + S6 on disk -------------------------------------------------------------------------
def _month_of(partition: str) -> int | None:
    value = partition.rsplit("=", 1)[1]
    return None if value == "__HIVE_DEFAULT_PARTITION__" else int(value)


def _spec(month: int | None) -> str:
    return f"PARTITION ({BRONZE_PARTITION} = {'null' if month is None else int(month)})"


def _folder_of(month: int | None) -> str:
    return f"{BRONZE_PARTITION}={'__HIVE_DEFAULT_PARTITION__' if month is None else month}"


def bronze_months(spark: SparkSession, bronze_path: str) -> list[int | None]:
    """The months of the stored Bronze (``None``: rows without ``createdAt``). Empty before the first load."""
    name = catalog_name(bronze_path)
    if not spark.catalog.tableExists(name):
        return []
    return [_month_of(r["partition"]) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]


def month_location(spark: SparkSession, bronze_path: str, month: int | None) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {catalog_name(bronze_path)} {_spec(month)}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def bronze_folders(spark: SparkSession, bronze_path: str) -> dict[int | None, str]:
    """The stored Bronze: month -> folder (relative to the table's)."""
    return {m: "/".join(month_location(spark, bronze_path, m).rsplit("/", 2)[1:]) for m in bronze_months(spark, bronze_path)}


def read_bronze(spark: SparkSession, bronze_path: str) -> DataFrame | None:
    """The stored Bronze with its ``created_month`` partition column, or ``None`` if it has no month."""
    return spark.table(catalog_name(bronze_path)) if bronze_months(spark, bronze_path) else None


def stored_folders(df: DataFrame) -> list[str]:
    """The folders of the files that a scan of ``df`` reads."""
    return sorted({unquote(f).rsplit("/", 1)[0] for f in df.inputFiles()})


def at_once(spark: SparkSession, jobs: Sequence[Callable]) -> list:
    """Run independent jobs of the session side by side; small ones leave most of a cluster idle."""
    with ThreadPoolExecutor(max_workers=8) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


def switch_months(
    spark: SparkSession, bronze_path: str, folder: str, written: Sequence[int | None], replaced: Sequence[int | None]
) -> None:
    """Point the months ``written`` to their folders below ``folder`` and drop the months of ``replaced`` that
    were not written. Months that gain rows change before months go."""
    name = catalog_name(bronze_path)
    there = set(bronze_months(spark, bronze_path))
    fresh = [m for m in written if m not in there]
    moved = [m for m in written if m in there]
    left = stored_folders(spark.table(name).filter(months_filter(moved))) if moved else []
    if fresh:
        parts = " ".join(f"{_spec(m)} LOCATION {_quoted(f'{folder}/{_folder_of(m)}')}" for m in fresh)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
    at_once(
        spark,
        [lambda m=m: spark.sql(f"ALTER TABLE {name} {_spec(m)} SET LOCATION {_quoted(f'{folder}/{_folder_of(m)}')}") for m in moved],
    )
    drop_month_partitions(spark, bronze_path, [m for m in replaced if m not in set(written)])
    for old in table_property(spark, bronze_path, "left_behind") or []:
        if old not in left:
            delete_path(spark, old)
    set_table_property(spark, bronze_path, "left_behind", left)


def write_bronze(
    bronze_path: str,
    batch: DataFrame,
    replace: bool = False,
    key_partition_stable: bool = True,
    newer_wins: bool = False,
    batch_bytes: int | None = None,
    batch_rows: int | None = None,
    months: Sequence[int | None] | None = None,
    watch: Callable[[DataFrame], DataFrame] | None = None,
    beside: Callable[[], object] | None = None,
) -> None:
    """Upsert ``batch`` into the month-partitioned Bronze at ``bronze_path`` and switch its months over.

    ``batch_rows`` and ``months`` (what the batch holds and touches) save a scan of the batch each if they are
    known. ``watch`` is handed the rows on their way to the files and returns them, with what it wants observed.
    ``beside`` is a job on the table as it was: it runs while the files are written and is done before the switch.

    * First load, or ``replace`` (full refresh): the batch is the whole table.
    * Stable months (default): read only the months the batch touches and the NULL month (whose ids
      move when ``createdAt`` is repaired), upsert them, and write just those anew.
    * ``key_partition_stable=False`` (an id may change month): all months are read and written anew.
    * ``newer_wins``: instead of "the batch always wins", a batch row replaces the stored one only
      if its ``(updatedAt, stage)`` is newer, where ``stage`` is the row's place in the life
      cycle (streams: replays and out-of-order files cannot regress a row, not even at equal times). Months
      for which the batch brings nothing newer are left as they are.

    The batch's ids are broadcast to the anti join when their checked size allows (the batch is staged
    on disk, so the check is a cheap scan); then the touched months (terabytes at scale) are never
    shuffled by id. Above the bound the join shuffles.
    """
    from tierwise.operators.extensions import broadcast_if_small, row_width
    from tierwise.session import cut_lineage

    spark = batch.sparkSession
    batch_p = with_partition_column(batch.select(*BRONZE_COLUMNS))
    order = WRITE_ORDER["bronze_retail_transactions"]
    create_table(spark, bronze_path, batch_p.schema, [BRONZE_PARTITION])
    there = bronze_months(spark, bronze_path)
    read: list[int | None] = []
    if there and not replace:
        read = list(there)
        if key_partition_stable:
            # months are a handful of scalars per batch (bounded by the calendar, not by the data)
            read = [m for m in {*(touched_months(batch_p) if months is None else months), None} if m in there]
    if newer_wins and (read or batch_rows is None):
        # rows whose stored version is newer go first: the months are scanned (versions only) against the broadcast
        # batch versions. What is left is fixed, and only its months are rewritten
        if read:
            before = read_bronze(spark, bronze_path).filter(months_filter(read))
            versions = broadcast_if_small(batch_p.select("id", version_of().alias("_bv")), materialize=False, rows=batch_rows)
            stale = before.join(versions, "id").filter(version_of() >= F.col("_bv")).select("id").distinct()
            batch_p = batch_p.join(stale, "id", "left_anti")
        batch_p = cut_lineage(batch_p)
        batch_rows = batch_p.count()
        read = [m for m in {*touched_months(batch_p), None} if m in there] if there and key_partition_stable else read
    if newer_wins:
        if not batch_rows:
            return
        batch_bytes = batch_rows * row_width(batch_p)
    merged = batch_p
    if read:
        stored = read_bronze(spark, bronze_path).filter(months_filter(read)).select(*BRONZE_COLUMNS, BRONZE_PARTITION)
        keys = broadcast_if_small(batch_p.select("id"), materialize=False, rows=batch_rows)
        merged = upsert_by_key(stored, batch_p, "id", batch_keys=keys)
    seen = Observation(f"bronze-{uuid.uuid4().hex}")
    month = F.col(BRONZE_PARTITION)
    notes = [F.collect_set(month).alias("months"), F.count_if(month.isNull()).alias("without")]

    def observed(rows: DataFrame) -> DataFrame:
        return (watch(rows) if watch else rows).observe(seen, *notes)

    folder = f"{bronze_path.rstrip('/')}/gen={uuid.uuid4().hex}"
    sized = None
    if batch_bytes is not None:
        sized = batch_bytes + (sum(folder_bytes(spark, f) for f in stored_folders(stored)) if read else 0)
    # months are written side by side, however small they are
    least = min(spark.sparkContext.defaultParallelism, len(read) or 12)

    def write() -> None:
        sorted_for_write(merged, order, [BRONZE_PARTITION], sized, observed, least).write.partitionBy(BRONZE_PARTITION).parquet(folder)

    at_once(spark, [write, *([beside] if beside else [])])
    found = seen.get
    written = [*found["months"], *([None] if found["without"] else [])]
    switch_months(spark, bronze_path, folder, written, there if replace else read)


def version_of() -> Column:
    """What orders two versions of a row: the update time, then the place in the life cycle (a soft
    delete after all)."""
    stage = F.lit(-1)
    for i, status in enumerate(STATUSES):
        stage = F.when(F.col("lastStatus") == status, F.lit(i)).otherwise(stage)
    return F.struct(F.col("updatedAt"), F.col("deletedAt").isNotNull().alias("_gone"), stage.alias("_stage"))


# --- S15 on disk ----------------------------------------------------------------------------
def drop_month_partitions(spark: SparkSession, bronze_path: str, months: Sequence[int | None]) -> list[int | None]:
    """Retention: ``DROP PARTITION`` for the months that are there (no data is read or rewritten; the table is
    managed, so their files go, too). Returns the months removed."""
    there = set(bronze_months(spark, bronze_path))
    gone = [m for m in months if m in there]
    if gone:
        spark.sql(f"ALTER TABLE {catalog_name(bronze_path)} DROP IF EXISTS {', '.join(map(_spec, gone))}")
    return gone


# --- tables of signed counts ----------------------------------------------------------------
LOAD_PARTITION = "load"
#: Loads whose deltas stand beside the base before they are folded into it.
DELTAS_KEPT = 24


def _loads(spark: SparkSession, path: str) -> list[int]:
    return [int(r["partition"].rsplit("=", 1)[1]) for r in spark.sql(f"SHOW PARTITIONS {catalog_name(path)}").collect()]


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a table of counts, the base's and the deltas'; readers sum them."""
    return spark.table(catalog_name(path)).drop(LOAD_PARTITION)


def store_counts(spark: SparkSession, path: str, counts: DataFrame, load: int, replace: bool) -> None:
    """Add one partition of counts, a delta of load ``load``, or with ``replace`` a new base instead of all others.
    A rerun of the same load overwrites its own partition."""
    name = create_table(spark, path, T.StructType([*counts.schema, T.StructField(LOAD_PARTITION, T.IntegerType())]), [LOAD_PARTITION])
    counts.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{LOAD_PARTITION}={load}")
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({LOAD_PARTITION} = {load})")
    spark.catalog.refreshTable(name)
    if replace:
        others = ", ".join(f"PARTITION ({LOAD_PARTITION} = {n})" for n in _loads(spark, path) if n != load)
        if others:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {others}")


# --- stored watermark -----------------------------------------------------------------------
STATE_FIELDS = ("watermark", "load_at", "batch_rows", "checks_passed", "gold_wm", "load_number")


def read_state(spark: SparkSession, state_path: str) -> dict | None:
    """The stored load state (``STATE_FIELDS``) or ``None``."""
    return table_property(spark, state_path, "load_state")


def read_watermark(spark: SparkSession, state_path: str) -> str | None:
    """The committed watermark, or ``None`` before the first committed load."""
    state = read_state(spark, state_path)
    return None if state is None else state["watermark"]


def store_watermark(
    spark: SparkSession,
    state_path: str,
    wm: str | None,
    load_at: str,
    batch_rows: int,
    checks_passed: bool | None = None,
    gold_wm: str | None = None,
    load_number: int = 0,
) -> None:
    """Commit point of a load: called only after the Bronze write returned (``checks_passed`` is unknown at that
    moment and recorded by a later call once the checks have run). ``gold_wm`` is the watermark that the count
    tables of Gold are in step with, ``None`` while they are not in step with Bronze."""
    create_table(spark, state_path, T.StructType([T.StructField("note", T.StringType())]))
    row = (wm, load_at, int(batch_rows), checks_passed, gold_wm, load_number)
    set_table_property(spark, state_path, "load_state", dict(zip(STATE_FIELDS, row, strict=True)))
