"""Deterministic test inputs derived from the driver's TPC-H-like tables.

``retail_transactions`` (clean source), ``retail_transaction_changes`` (every version of every
row), ``snapshot_at`` (the source as it stood at a cut time) and ``retail_transactions_dirty``
(planted violations). Every row comes from ``orders`` joined to ``customer`` and ``nation`` so the
work grows with the tables. All timestamps are ``timestamp_ntz`` (zone-free).

Per order key ``k``:
  id             'TRX-' || k padded with zeros to 8 digits (longer keys stay whole)
  customerId     'CUST-' || o_custkey
  lastStatus     STATUSES[k % 6]
  posOrigin      nation name of the customer
  posDestination nation name of nation key (7k + 3) % 25
  createdAt      o_orderdate + (7919k % 86400) s + (104729k % 10^6) us
  updatedAt      as_of - ((k div 24) % 48 * 1800 + k % 1800) s   if k % 6 < 4 and (k div 6) % 4 = 0
                 createdAt + (31337k % 864000) s                otherwise
  deletedAt      updatedAt if DELIVERED and k % 7 = 0
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.functions import ts_literal
from tierwise.schemas import LIFECYCLE_CHAIN, SOURCE_COLUMNS, STATUSES

# --- fixed scenario parameters (shared with the DuckDB oracle) --------------------------
AS_OF = "2001-09-01 00:17:00"
REPLAY_CUTS = (
    "1997-01-01 00:00:00",
    "1999-06-01 12:00:00",
    "2001-08-31 20:00:00",
    "2001-09-01 00:17:00",
)
# ----------------------------------------------------------------------------------------
#: Times at which the stuck parcels are asked for.
AGING_TIMES = (AS_OF, "2001-08-31 07:30:00", "2001-09-03 23:59:59")


# Columns of the driver tables the fixtures use (explicit schemas: no inference, and only these
# columns are read).
DRIVER_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_key_of(id_col: Column) -> Column:
    """Recover ``k`` from ``TRX-n...`` (eight digits or more)."""
    return F.substring(id_col, 5, 64).cast("bigint")


def _sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _keyed_rows(spark: SparkSession, sf_dir: str, as_of: str) -> DataFrame:
    """Clean source rows plus the internal order key column ``k``.

    The per-row formulas are Spark SQL expressions (``selectExpr``): parsed once in the JVM, the
    same whole-stage-codegen plan as the Column API, without hundreds of driver round trips."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    # fact -> dimension -> sub-dimension. Joining orders to the two pruned customer columns first
    # lets Catalyst size the customer side from its files: broadcast while it is small, a shuffled
    # join once it is large. nation (25 rows) is broadcast for both city lookups.
    origin = nation.selectExpr("n_nationkey AS c_nationkey", "n_name AS posOrigin")
    dest = nation.selectExpr("CAST(n_nationkey AS BIGINT) AS dest_key", "n_name AS posDestination")
    base = (
        orders.join(customer.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey", "left")
        .join(origin, "c_nationkey", "left")
        .withColumn("dest_key", F.expr("(o_orderkey * 7 + 3) % 25"))
        .join(dest, "dest_key", "left")
    )
    return base.selectExpr(
        "o_orderkey AS k",
        "concat('TRX-', lpad(CAST(o_orderkey AS STRING), greatest(8, length(CAST(o_orderkey AS STRING))), '0')) AS id",
        "concat('CUST-', CAST(o_custkey AS STRING)) AS customerId",
        f"element_at(array({_sql_list(STATUSES)}), CAST(o_orderkey % 6 + 1 AS INT)) AS lastStatus",
        "posOrigin",
        "posDestination",
        "timestampadd(MICROSECOND, o_orderkey * 104729 % 1000000,"
        " timestampadd(SECOND, o_orderkey * 7919 % 86400, CAST(o_orderdate AS TIMESTAMP_NTZ))) AS createdAt",
    ).selectExpr(
        "*",
        "CASE WHEN k % 6 < 4 AND (k div 6) % 4 = 0"
        f" THEN timestampadd(SECOND, -(((k div 24) % 48) * 1800 + k % 1800), TIMESTAMP_NTZ '{as_of}')"
        " ELSE timestampadd(SECOND, k * 31337 % 864000, createdAt) END AS updatedAt",
    ).selectExpr("*", "CASE WHEN k % 6 = 4 AND k % 7 = 0 THEN updatedAt END AS deletedAt")


def retail_transactions(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    """Clean operational table as of ``as_of`` (one row per id)."""
    return _keyed_rows(spark, sf_dir, as_of).select(*SOURCE_COLUMNS)


def retail_transaction_changes(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    """Every version of every row (a change feed), with ``version`` = step number ``j``.

    Steps ``j = 0..n``; ``n`` per final status: BOOKED 1 (one touch), PROCESSING 1, IN_TRANSIT 2,
    OUT_FOR_DELIVERY 3, DELIVERED 4 (5 when soft deleted), CANCELLED ``1 + (k div 6) % 4``.
    Status at ``j``: CANCELLED at the last step of a cancelled row, BOOKED throughout for BOOKED
    rows, else lifecycle element ``least(j, 4)``. Time at ``j``: the final ``updatedAt`` at ``j = n``,
    else ``createdAt + floor(S * j / n)`` seconds with ``S`` the whole seconds between the two.
    ``deletedAt`` only on step 5. Steps are generated with ``explode(sequence(0, n))`` (no join).
    """
    rows = _keyed_rows(spark, sf_dir, as_of)
    return (
        rows.selectExpr(
            "*",
            "CAST(CASE lastStatus WHEN 'BOOKED' THEN 1 WHEN 'PROCESSING' THEN 1 WHEN 'IN_TRANSIT' THEN 2"
            " WHEN 'OUT_FOR_DELIVERY' THEN 3"
            " WHEN 'DELIVERED' THEN CASE WHEN deletedAt IS NOT NULL THEN 5 ELSE 4 END"
            " ELSE 1 + (k div 6) % 4 END AS INT) AS n",
            "CAST(floor(timestampdiff(MICROSECOND, createdAt, updatedAt) / 1000000) AS BIGINT) AS S",
        )
        .selectExpr("*", "explode(sequence(0, n)) AS version")
        .selectExpr(
            "id",
            "customerId",
            "CASE WHEN lastStatus = 'CANCELLED' AND version = n THEN 'CANCELLED'"
            " WHEN lastStatus = 'BOOKED' THEN 'BOOKED'"
            f" ELSE element_at(array({_sql_list(LIFECYCLE_CHAIN)}), least(version, 4) + 1) END AS lastStatus",
            "posOrigin",
            "posDestination",
            "createdAt",
            "CASE WHEN version = n THEN updatedAt"
            " ELSE timestampadd(SECOND, CAST(floor(S * version / n) AS BIGINT), createdAt) END AS updatedAt",
            "CASE WHEN version = 5 THEN deletedAt END AS deletedAt",
            "version",
        )
    )


def snapshot_at(changes: DataFrame, cut: str) -> DataFrame:
    """The source table as it stood at ``cut``: per id, the latest version (greatest
    ``(updatedAt, version)``) with ``updatedAt <= cut``.

    Uses ``max(struct)`` per id: an aggregate, so it is partially combined before the shuffle and a
    hot id cannot pile its versions into one task."""
    live = changes.filter(F.col("updatedAt") <= ts_literal(cut))
    payload = [c for c in SOURCE_COLUMNS if c not in ("id", "updatedAt")]
    latest = live.groupBy("id").agg(
        F.max(F.struct("updatedAt", "version", *payload)).alias("v")
    )
    return latest.select("id", *[F.col(f"v.{c}").alias(c) for c in SOURCE_COLUMNS if c != "id"]).select(
        *SOURCE_COLUMNS
    )


def snapshots_at(changes: DataFrame, cuts: Sequence[str]) -> DataFrame:
    """The rows of ``snapshot_at`` for all ``cuts``, each with the place of its cut in ``cut``: one pass over the
    change feed and one exchange by id, however many cuts there are."""
    order = sorted(range(len(cuts)), key=lambda i: _dt.datetime.fromisoformat(cuts[i]))
    t = F.col("updatedAt")
    live = changes.filter(t <= ts_literal(cuts[order[-1]]))
    version = F.struct("updatedAt", "version", *[c for c in SOURCE_COLUMNS if c not in ("id", "updatedAt")])
    # a version counts once, from the first cut that it is not after; a snapshot is the greatest of its cut and those before
    since = [t <= ts_literal(cuts[i]) if n == 0 else (t > ts_literal(cuts[order[n - 1]])) & (t <= ts_literal(cuts[i])) for n, i in enumerate(order)]
    latest = live.groupBy("id").agg(
        *[F.max(F.when(cond, version)).alias(f"_m{n}") for n, cond in enumerate(since)]
    )
    at = {i: F.greatest(*[F.col(f"_m{m}") for m in range(n + 1)]) if n else F.col("_m0") for n, i in enumerate(order)}
    found = F.array(*[F.struct(F.lit(i).alias("cut"), at[i].alias("v")) for i in range(len(cuts))])
    rows = latest.select("id", F.explode(found).alias("_at")).filter("_at.v IS NOT NULL")
    return rows.select("id", *[F.col(f"_at.v.{c}").alias(c) for c in SOURCE_COLUMNS if c != "id"], "_at.cut").select(
        *SOURCE_COLUMNS, "cut"
    )


def retail_transactions_dirty(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    """Clean source with planted violations (first matching rule wins for the status):

    * status NULL if ``k % 107 = 0``; ``'DELIVRED'`` if ``k % 103 = 0``;
      ``'  ' || lower(status) || ' '`` if ``k % 101 = 0``;
    * ``customerId`` with a leading space (every row);
    * ``createdAt`` NULL if ``k % 113 = 0``;
    * ``updatedAt = createdAt - 2 days`` if ``k % 109 = 0`` (original ``createdAt``), NULL if
      ``k % 139 = 0``;
    * rows with ``k % 97 = 0`` or ``k % 151 = 0`` appear twice (``explode`` of a 1- or 2-element
      array: one scan, no self-union);
    * ``id`` NULL if ``k % 157 = 0``; the second copy of ``k % 151 = 0`` has a trailing space (unique
      in Bronze, not in Silver); spaces on both sides if ``k % 149 = 0``;
    * ``posOrigin`` NULL if ``k % 163 = 0``, with spaces on both sides if ``k % 167 = 0``;
      ``posDestination`` with two leading spaces if ``k % 173 = 0``.
    """
    return (
        _keyed_rows(spark, sf_dir, as_of)
        .selectExpr("*", "explode(CASE WHEN k % 97 = 0 OR k % 151 = 0 THEN array(0, 1) ELSE array(0) END) AS _copy")
        .selectExpr(
            "CASE WHEN k % 157 = 0 THEN CAST(NULL AS STRING) WHEN k % 151 = 0 AND _copy = 1 THEN concat(id, ' ')"
            " WHEN k % 149 = 0 THEN concat(' ', id, '  ') ELSE id END AS id",
            "concat(' ', customerId) AS customerId",
            "CASE WHEN k % 107 = 0 THEN CAST(NULL AS STRING) WHEN k % 103 = 0 THEN 'DELIVRED'"
            " WHEN k % 101 = 0 THEN concat('  ', lower(lastStatus), ' ') ELSE lastStatus END AS lastStatus",
            "CASE WHEN k % 163 = 0 THEN CAST(NULL AS STRING) WHEN k % 167 = 0 THEN concat(' ', posOrigin, ' ')"
            " ELSE posOrigin END AS posOrigin",
            "CASE WHEN k % 173 = 0 THEN concat('  ', posDestination) ELSE posDestination END AS posDestination",
            "CASE WHEN k % 113 = 0 THEN CAST(NULL AS TIMESTAMP_NTZ) ELSE createdAt END AS createdAt",
            "CASE WHEN k % 139 = 0 THEN CAST(NULL AS TIMESTAMP_NTZ)"
            " WHEN k % 109 = 0 THEN timestampadd(SECOND, -172800, createdAt) ELSE updatedAt END AS updatedAt",
            "deletedAt",
        )
        .select(*SOURCE_COLUMNS)
    )


# --- planted violations on derived layers (checks that Silver itself cannot violate) ----------
PLANTED_RATE_ROUTES = (
    # (origin, destination, success_rate_pct, cancelled_rate_pct)
    ("NATION_1", "NATION_1", 120.0, None),
    ("NATION_2", "NATION_2", -1.0, None),
    ("NATION_3", "NATION_3", 60.0, 60.0),
)


def plant_flag_flips(silver: DataFrame) -> DataFrame:
    """Flip ``is_deleted`` where ``k % 127 = 0``."""
    k = order_key_of(F.col("id"))
    return silver.withColumn(
        "is_deleted",
        F.when(k % F.lit(127) == 0, F.lit(1) - F.col("is_deleted")).otherwise(F.col("is_deleted")).cast("int"),
    )


def plant_grain_duplicates(valid: DataFrame, comprehensive: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A broken GROUP BY: repeat the same-city rows of BOOKED (valid) / CANCELLED (comprehensive)."""
    same_city = F.col("pos_origin") == F.col("pos_destination")
    v = valid.unionByName(valid.filter(same_city & (F.col("last_status") == "BOOKED")))
    c = comprehensive.unionByName(comprehensive.filter(same_city & (F.col("last_status") == "CANCELLED")))
    return v, c


def plant_rates(success: DataFrame) -> DataFrame:
    """Set out-of-range percentages on three routes."""
    s, c = F.col("success_rate_pct"), F.col("cancelled_rate_pct")
    for origin, dest, ns, nc in PLANTED_RATE_ROUTES:
        hit = (F.col("pos_origin") == origin) & (F.col("pos_destination") == dest)
        s = F.when(hit, F.lit(ns)).otherwise(s)
        if nc is not None:
            c = F.when(hit, F.lit(nc)).otherwise(c)
    return success.withColumn("success_rate_pct", s.cast("double")).withColumn("cancelled_rate_pct", c.cast("double"))


def changes_with_illegal_moves(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    """The change feed plus one extra, illegal version (one hour after the final one) for:
    ``k % 89 = 0`` delivered, not deleted -> PROCESSING (regression);
    ``k % 79 = 0`` cancelled -> BOOKED (resurrection);
    ``k % 73 = 0`` in transit -> DELIVERED (skips OUT_FOR_DELIVERY);
    and, for ``k % 71 = 0``, a PROCESSING version without a time (it sorts first: an illegal start)."""
    changes = retail_transaction_changes(spark, sf_dir, as_of)
    planted = (
        _keyed_rows(spark, sf_dir, as_of)
        .selectExpr(
            "*",
            "CASE WHEN k % 89 = 0 AND lastStatus = 'DELIVERED' AND deletedAt IS NULL THEN 'PROCESSING'"
            " WHEN k % 79 = 0 AND lastStatus = 'CANCELLED' THEN 'BOOKED'"
            " WHEN k % 73 = 0 AND lastStatus = 'IN_TRANSIT' THEN 'DELIVERED'"
            " WHEN k % 71 = 0 THEN 'PROCESSING' END AS _to",
            "k % 71 = 0 AND NOT coalesce(k % 89 = 0 AND lastStatus = 'DELIVERED' AND deletedAt IS NULL"
            " OR k % 79 = 0 AND lastStatus = 'CANCELLED' OR k % 73 = 0 AND lastStatus = 'IN_TRANSIT', false) AS _timeless",
        )
        .filter("_to IS NOT NULL")
        .selectExpr(
            "id",
            "customerId",
            "_to AS lastStatus",
            "posOrigin",
            "posDestination",
            "createdAt",
            "CASE WHEN NOT _timeless THEN timestampadd(SECOND, 3600, updatedAt) END AS updatedAt",
            "CAST(NULL AS TIMESTAMP_NTZ) AS deletedAt",
            "6 AS version",
        )
    )
    return changes.unionByName(planted)


def source_with_hard_deletes(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> DataFrame:
    """The clean source after rows with ``k % 131 = 0`` were hard deleted upstream."""
    return (
        _keyed_rows(spark, sf_dir, as_of).filter(F.col("k") % F.lit(131) != 0).select(*SOURCE_COLUMNS)
    )
