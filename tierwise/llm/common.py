"""Shared helpers: whole-text words, a one-time binding for Column lambdas, staged tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.session import checkpoint_dir

#: The six characters that end a word.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a non-null text; the empty array if there is none."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN, -1))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body (or a lambda
    inside it) names it."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def crc_mod(doc_id: Column, n: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back: lineage ends in
    files every executor can read."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """Bound the Arrow batches that go to Python by bytes: the default of 64 MB holds several copies of as much
    text in the executor and in each worker. A session that has set its own bound keeps it."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key).lower().removesuffix("b") in ("67108864", "64m"):
        spark.conf.set(key, size)


def unused(name: str, columns: list[str]) -> str:
    """``name``, made longer until no column has it (names differ by more than case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def width(spark: SparkSession) -> int:
    """Number of shards for explicit exchanges: the session's shuffle width, which a cluster sizes to its data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
