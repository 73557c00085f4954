"""E5: Bronze fed by Structured Streaming instead of an hourly batch.

A file source over a folder of change batches (Parquet, fixed schema) drives ``foreachBatch``:

1. Versions that came in already fall in the stream: a keyed state holds (id, version columns) for ``replay_hours``
   after they arrived (``dropDuplicatesWithinWatermark`` on the time of arrival, so no row is ever late). The state
   lies on disk, so it is not bounded by the executors' memory.
2. Each micro-batch is reduced to the latest version per id and projected to Bronze, once: it is staged, since what
   follows reads it several times and each read would run the stream's state and exchanges again.
3. Versions older than what Bronze has are dropped before anything is written: only the months that hold a newer
   version are rewritten, and a micro-batch of stale rows rewrites none.

Newer is by update time, and at equal times by the place in the life cycle (Bronze keeps no version number). That
makes a replay after the state has forgotten it (or after a failure: at-least-once) and out-of-order files harmless,
too. ``load_at`` is the time of the micro-batch unless fixed. Progress and state are kept in the stream's
checkpoint folder, which must be on shared storage.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.operators.load import latest_per_key
from tierwise.plans import storage
from tierwise.plans.pipeline import stage_batch
from tierwise.schemas import BRONZE_COLUMNS, SOURCE_COLUMNS
from tierwise.session import checkpoint_dir


VERSION_COLUMNS = ("id", "lastStatus", "updatedAt", "deletedAt")

#: Settings of the stream. The state has a row for each version of ``replay_hours`` and lies on the executors' disks
#: (the default provider keeps it in the heap); all its partitions on an executor share the memory given here. Its rows
#: are not counted, which would cost a read for each write.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


@contextmanager
def stream_settings(spark: SparkSession) -> Iterator[None]:
    """Streams started inside take those of ``STREAM_SETTINGS`` that the session does not set itself. A stream copies the
    session's settings when it starts, so the session has its own again afterwards; one that goes on from a
    checkpoint keeps the state provider it began with."""
    added = {k: v for k, v in STREAM_SETTINGS.items() if spark.conf.get(k, None) is None}
    try:
        for k, v in added.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k in added:
            spark.conf.unset(k)


def upsert_micro_batch(batch: DataFrame, bronze_path: str, as_of: str | None, order: tuple[str, ...]) -> None:
    now = as_of or _dt.datetime.now().isoformat(sep=" ", timespec="seconds")
    ranked = batch.withColumn("_version", storage.version_of())
    latest = latest_per_key(ranked, ["id"], [*order, "_version"])
    staging = f"{checkpoint_dir(batch.sparkSession).rstrip('/')}/micro-batch-{uuid.uuid4().hex}"
    staged, seen = stage_batch(latest.select(*SOURCE_COLUMNS), None, now, staging)
    storage.write_bronze(bronze_path, staged.select(*BRONZE_COLUMNS), newer_wins=True, batch_rows=seen["n"], months=seen["months"])
    storage.delete_path(batch.sparkSession, staging)


def without_replays(stream: DataFrame, hours: int) -> DataFrame:
    """The stream without versions that arrived in the last ``hours`` already."""
    arrived = stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", f"{hours} hours")
    return arrived.dropDuplicatesWithinWatermark([c for c in (*VERSION_COLUMNS, "version") if c in stream.columns]).drop("_arrived")


def bronze_stream_upsert(
    spark: SparkSession,
    input_path: str,
    schema: T.StructType,
    bronze_path: str,
    checkpoint_path: str,
    as_of: str | None = None,
    order: tuple[str, ...] = ("updatedAt",),
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    max_bytes_per_trigger: int = 8 << 30,
    replay_hours: int = 24,
):
    """Start the stream; with ``available_now`` it drains the folder in several micro-batches and
    stops. Returns the ``StreamingQuery``. A micro-batch takes files up to ``max_bytes_per_trigger``
    (each rewrites the months it touches, so few large ones are best), or a number of files if given."""
    limit = ("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else ("maxBytesPerTrigger", max_bytes_per_trigger)
    stream = spark.readStream.schema(schema).option(*limit).parquet(input_path)
    writer = (
        without_replays(stream, replay_hours)
        .writeStream.foreachBatch(lambda df, _epoch: upsert_micro_batch(df, bronze_path, as_of, order))
        .option("checkpointLocation", checkpoint_path)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    with stream_settings(spark):
        return writer.start()
