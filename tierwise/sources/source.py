"""S1 source scan: the operational table read as a DataFrame.

The source is a mutable OLTP table. On a cluster it is read either from a Parquet snapshot/export
(zone-free timestamps) or over JDBC with a partitioned read. Either way the caller gets the eight
source columns with a fixed schema, never an inferred one, and later filters (the watermark) are
literal so they push into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.schemas import SOURCE_COLUMNS, source_schema


JDBC_PARTITIONING = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
TIMES = ("createdAt", "updatedAt", "deletedAt")


def conform_source(df: DataFrame) -> DataFrame:
    """Select the source columns in contract order with contract types (timestamps keep their
    zoned / zone-free flavour)."""
    schema = source_schema()
    cols = []
    for field in schema.fields:
        c = F.col(f"`{field.name}`")
        if field.name in TIMES:
            dt = df.schema[field.name].dataType
            cols.append(c.cast(dt).alias(field.name))
        else:
            cols.append(c.cast(field.dataType).alias(field.name))
    return df.select(*cols)


def read_source(
    spark: SparkSession,
    location: str,
    fmt: str = "parquet",
    jdbc_options: dict[str, str] | None = None,
) -> DataFrame:
    """Read the operational ``retail_transactions`` table.

    * ``fmt='parquet'``: ``location`` is a Parquet path (file or directory).
    * ``fmt='jdbc'``: ``location`` is the JDBC URL; ``jdbc_options`` carries ``dbtable`` and must
      carry ``partitionColumn/lowerBound/upperBound/numPartitions``: without them the whole table
      would be one task (a JDBC driver jar must be on the classpath; none ships with this repository).

    Columns of another type than the contract's are refused, not cast; timestamps may be zoned or not.
    """
    if fmt == "parquet":
        df = spark.read.schema(_given_schema(spark, location)).parquet(location)
    elif fmt == "jdbc":
        lacking = [k for k in JDBC_PARTITIONING if k not in (jdbc_options or {})]
        if lacking:
            raise ValueError(f"a JDBC source needs the options {lacking} for a partitioned read")
        opts = {"url": location, "dbtable": "retail_transactions"}
        opts.update(jdbc_options or {})
        df = spark.read.format("jdbc").options(**opts).load()
    else:
        df = spark.read.format(fmt).load(location)
    _refuse_missing(df, location)
    return conform_source(df)


def _refuse_missing(df: DataFrame, location: str) -> None:
    missing = [c for c in SOURCE_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"source at {location!r} lacks columns {missing}")


def _given_schema(spark: SparkSession, location: str) -> T.StructType:
    """The contract's schema, with the zoned or zone-free flavour that a file's footer tells of each time. Read with
    it, a file of another type fails instead of being cast."""
    stored = spark.read.parquet(location)
    _refuse_missing(stored, location)
    fields = []
    for field in source_schema().fields:
        kind = stored.schema[field.name].dataType
        same = isinstance(kind, (T.TimestampType, T.TimestampNTZType)) if field.name in TIMES else kind == field.dataType
        if not same:
            raise ValueError(f"source at {location!r}: {field.name} is {kind.simpleString()}")
        fields.append(T.StructField(field.name, kind, True))
    return T.StructType(fields)
