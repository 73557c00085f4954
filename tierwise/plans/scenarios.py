"""Named inputs for the registered queries: each builds a layer from the driver tables through the
fixtures, so every query's work grows with ``sf_dir``."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.functions import hours_between, ts_literal
from tierwise.operators.load import bronze_projection
from tierwise.operators.silver import silver_cleansed
from tierwise.sources.fixtures import AS_OF, retail_transactions, retail_transactions_dirty


def clean_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail_transactions(spark, sf_dir, AS_OF)


def clean_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after a first (full) load of the clean source at ``AS_OF``."""
    return bronze_projection(clean_source(spark, sf_dir), AS_OF)


def clean_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_cleansed(clean_bronze(spark, sf_dir))


def dirty_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retail_transactions_dirty(spark, sf_dir, AS_OF)


def dirty_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze after a full load of the source with planted violations."""
    return bronze_projection(dirty_source(spark, sf_dir), AS_OF)


def dirty_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_cleansed(dirty_bronze(spark, sf_dir))


# --- replayed incremental loads over the change feed ------------------------------------------
from dataclasses import dataclass, field  # noqa: E402


from tierwise.operators.load import apply_load, with_partition_column  # noqa: E402
from tierwise.plans import pipeline, storage  # noqa: E402
from tierwise.schemas import source_schema  # noqa: E402
from tierwise.session import checkpoint_dir  # noqa: E402
from tierwise.sources.source import read_source  # noqa: E402
from tierwise.sources.fixtures import REPLAY_CUTS, retail_transaction_changes, snapshots_at  # noqa: E402


@dataclass
class Replay:
    """Bronze after each load (staged), the batch each load landed, the watermark it started from
    (``None`` = full load) and the source it read (an export)."""

    states: list[DataFrame] = field(default_factory=list)
    batches: list[DataFrame] = field(default_factory=list)
    watermarks: list[str | None] = field(default_factory=list)
    sources: list[DataFrame] = field(default_factory=list)


def source_exports(spark: SparkSession, sf_dir: str, cuts: tuple[str, ...], path: str) -> list[str]:
    """The source as it stood at each cut, written as Parquet folders below ``path`` by one pass over the change
    feed; returns the folders."""
    snapshots_at(retail_transaction_changes(spark, sf_dir, AS_OF), cuts).write.partitionBy("cut").parquet(path)
    folders = [f"{path}/cut={i}" for i in range(len(cuts))]
    for folder in folders:
        if not storage.path_exists(spark, folder):  # no row is that old
            spark.createDataFrame([], source_schema()).write.parquet(folder)
    return folders


def replay(spark: SparkSession, sf_dir: str, cuts: tuple[str, ...] = REPLAY_CUTS) -> Replay:
    """Run one load per cut: source = snapshot of the change feed at the cut, ``as_of`` = the cut.
    Each source and each Bronze state is written as Parquet to the shared checkpoint folder (cuts lineage,
    survives executor loss; a load scans its batch with the watermark pushed down, and the next watermark
    reads one column, without recomputing the chain)."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/replay-{uuid.uuid4().hex}"
    out = Replay()
    bronze = None
    for i, (cut, folder) in enumerate(zip(cuts, source_exports(spark, sf_dir, cuts, f"{base}/source"))):
        src = spark.read.schema(source_schema()).parquet(folder)
        bronze, batch, wm = apply_load(bronze, src, cut)
        bronze = storage.write_staging(bronze, f"{base}/bronze/{i}")
        out.states.append(bronze)
        out.batches.append(batch)
        out.watermarks.append(wm)
        out.sources.append(src)
    return out


def appended_log(rep: Replay) -> DataFrame:
    """Every batch appended without the keyed upsert (what a plain append would hold), and appended
    again an hour later (a load that was run twice), with the month partition column."""
    log = rep.batches[0]
    for b in rep.batches[1:]:
        log = log.unionByName(b)
    return with_partition_column(log.unionByName(log.withColumn("load_at", F.expr("timestampadd(HOUR, 1, load_at)"))))


def source_files(spark: SparkSession, sf_dir: str) -> str:
    """The clean source written as a Parquet export, sorted by update time so that its files have narrow ranges;
    returns the folder."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/source-{uuid.uuid4().hex}"
    clean_source(spark, sf_dir).repartitionByRange("updatedAt").sortWithinPartitions("updatedAt").write.parquet(path)
    return path


def stored_bronze(spark: SparkSession, sf_dir: str) -> str:
    """Bronze after a first load of the clean source, as the catalog table that a build writes; returns its path."""
    path = storage.Warehouse(f"{checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}").path("bronze", pipeline.BRONZE)
    storage.write_bronze(path, clean_bronze(spark, sf_dir))
    return path


def after_fastest_deleted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(Bronze, the batch of a later load that soft-deletes every parcel with its route's shortest lead time)."""
    bronze = clean_bronze(spark, sf_dir)
    live = silver_cleansed(bronze, ("struct(*) AS _raw",)).where("last_status = 'DELIVERED' AND is_deleted = 0")
    live = live.withColumn("_lead", hours_between("created_at", "updated_at"))
    least = live.groupBy("pos_origin", "pos_destination").agg(F.min("_lead").alias("_least"))
    same = [live[c].eqNullSafe(least[c]) for c in ("pos_origin", "pos_destination")]
    fastest = live.join(least, [*same, live["_lead"] == least["_least"]], "left_semi").select("_raw.*")
    gone = ts_literal(AS_OF)
    return bronze, fastest.withColumn("updatedAt", gone).withColumn("deletedAt", gone)


# --- the shipped path: source files -> read_source -> build, hour by hour ---------------------------
def shipped_loads(spark: SparkSession, sf_dir: str, cuts: tuple[str, ...] = REPLAY_CUTS) -> Iterator[tuple[str, storage.Warehouse, DataFrame]]:
    """A fresh warehouse loaded once per cut: the source as it stood is written as Parquet, read with
    ``read_source`` and built. Yields (cut, warehouse, run report) after every load."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/shipped-{uuid.uuid4().hex}"
    wh = storage.Warehouse(f"{base}/warehouse")
    for cut, folder in zip(cuts, source_exports(spark, sf_dir, cuts, f"{base}/source")):
        report = pipeline.build(spark, read_source(spark, folder), wh, cut)
        storage.delete_path(spark, folder)
        yield cut, wh, report

