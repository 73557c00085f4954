"""M1-M5: the five Gold marts over Silver.

Shape of each: scan -> filter -> partial hash aggregate -> shuffle on the grain -> final
aggregate. The grains are low-cardinality (dates x statuses x routes), so the map-side partial
aggregate shrinks the data to a few rows per task before anything crosses the network; a hot route
is therefore harmless. ``processed_at`` is the build time passed in as ``as_of``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.functions import as_of_seconds, count_where, hours_between, pct, round_half_even, ts_literal
from tierwise.schemas import STUCK_HOURS_DEFAULT, TERMINAL_STATUSES


def _processed_at(silver: DataFrame, as_of: str) -> Column:
    return ts_literal(as_of_seconds(as_of), silver.schema["updated_at"].dataType).alias("processed_at")


def _as_of(silver: DataFrame, as_of: str) -> Column:
    return ts_literal(as_of_seconds(as_of), silver.schema["updated_at"].dataType)


def not_deleted() -> Column:
    return F.col("is_deleted") == F.lit(0)


# --- M1 -------------------------------------------------------------------------------------
def gold_daily_transaction_valid(silver: DataFrame, as_of: str) -> DataFrame:
    """Daily count of valid transactions: not deleted and not cancelled (NULL status drops)."""
    return (
        silver.filter(not_deleted() & (F.col("last_status") != F.lit("CANCELLED")))
        .groupBy(
            F.to_date("created_at").alias("transaction_date"), "last_status", "pos_origin", "pos_destination"
        )
        .agg(F.count("id").alias("total_valid_transactions"))
        .withColumn("processed_at", _processed_at(silver, as_of))
    )


# --- M2 -------------------------------------------------------------------------------------
def gold_daily_transaction_comprehensive(silver: DataFrame, as_of: str) -> DataFrame:
    """Daily count of every transaction; soft deletes are a column, cancellations are rows."""
    return (
        silver.groupBy(
            F.to_date("created_at").alias("transaction_date"), "last_status", "pos_origin", "pos_destination"
        )
        .agg(
            F.count("id").alias("total_transactions"),
            count_where(F.col("is_deleted") == F.lit(1)).alias("total_soft_deleted"),
        )
        .withColumn("processed_at", _processed_at(silver, as_of))
    )


# --- M3 -------------------------------------------------------------------------------------
def gold_route_performance_metrics(silver: DataFrame, as_of: str) -> DataFrame:
    """Lead time (hour boundaries from created to last update) of delivered, not deleted parcels
    per route. Deleted rows must stay out: a soft delete bumps ``updated_at``."""
    lead = hours_between("created_at", "updated_at")
    return (
        silver.filter((F.col("last_status") == F.lit("DELIVERED")) & not_deleted())
        .withColumn("_lead", lead)
        .groupBy("pos_origin", "pos_destination")
        .agg(
            F.count("id").alias("total_delivered_packages"),
            round_half_even(F.avg("_lead"), 2).alias("avg_delivery_time_hours"),
            F.min("_lead").alias("fastest_delivery_hours"),
            F.max("_lead").alias("slowest_delivery_hours"),
        )
        .withColumn("processed_at", _processed_at(silver, as_of))
    )


# --- M4 -------------------------------------------------------------------------------------
def stuck_parcels(silver: DataFrame, as_of: str, threshold: Column | int = STUCK_HOURS_DEFAULT) -> DataFrame:
    """Active (not terminal), not deleted parcels whose last update is ``>= threshold`` hour
    boundaries before ``as_of``; adds ``_hours`` (bigint). ``threshold`` may be a column (E4)."""
    hours = hours_between(F.col("updated_at"), _as_of(silver, as_of))
    thr = threshold if isinstance(threshold, Column) else F.lit(int(threshold))
    return (
        silver.filter(~F.col("last_status").isin(*TERMINAL_STATUSES) & not_deleted())
        .withColumn("_hours", hours)
        .filter(F.col("_hours") >= thr)
    )


def aging_aggregate(stuck: DataFrame, silver: DataFrame, as_of: str) -> DataFrame:
    return (
        stuck.groupBy("last_status", "pos_origin", "pos_destination")
        .agg(
            F.count("id").alias("total_stuck_packages"),
            round_half_even(F.avg("_hours"), 2).alias("avg_hours_stuck"),
            F.max("_hours").alias("max_hours_stuck"),
        )
        .withColumn("processed_at", _processed_at(silver, as_of))
    )


def gold_aging_bottleneck_alerts(
    silver: DataFrame, as_of: str, threshold_hours: int = STUCK_HOURS_DEFAULT
) -> DataFrame:
    """Parcels stuck in an active status: count, average and max hours since the last update.
    An empty result is the healthy state."""
    return aging_aggregate(stuck_parcels(silver, as_of, threshold_hours), silver, as_of)


# --- M5 -------------------------------------------------------------------------------------
def gold_delivery_success_rate(silver: DataFrame, as_of: str) -> DataFrame:
    """Delivered and cancelled shares of all not-deleted parcels per route (the denominator
    includes parcels still in flight), rounded half-even to 2 decimals."""
    delivered = count_where(F.col("last_status") == F.lit("DELIVERED"))
    cancelled = count_where(F.col("last_status") == F.lit("CANCELLED"))
    total = F.count("id")
    return (
        silver.filter(not_deleted())
        .groupBy("pos_origin", "pos_destination")
        .agg(
            total.alias("total_packages"),
            delivered.alias("total_delivered"),
            cancelled.alias("total_cancelled"),
            round_half_even(pct(delivered, total), 2).alias("success_rate_pct"),
            round_half_even(pct(cancelled, total), 2).alias("cancelled_rate_pct"),
        )
        .filter(F.col("total_packages") > F.lit(0))
        .withColumn("processed_at", _processed_at(silver, as_of))
    )


MARTS = {
    "gold_daily_transaction_valid": gold_daily_transaction_valid,
    "gold_daily_transaction_comprehensive": gold_daily_transaction_comprehensive,
    "gold_route_performance_metrics": gold_route_performance_metrics,
    "gold_aging_bottleneck_alerts": gold_aging_bottleneck_alerts,
    "gold_delivery_success_rate": gold_delivery_success_rate,
}

# O1: the read order each mart documents (name, descending?), with the grain as a tiebreak so
# the order is total.
READ_ORDER = {
    "gold_route_performance_metrics": (
        ("total_delivered_packages", True),
        ("pos_origin", False),
        ("pos_destination", False),
    ),
    "gold_aging_bottleneck_alerts": (
        ("total_stuck_packages", True),
        ("avg_hours_stuck", True),
        ("last_status", False),
        ("pos_origin", False),
        ("pos_destination", False),
    ),
    "gold_delivery_success_rate": (
        ("total_packages", True),
        ("pos_origin", False),
        ("pos_destination", False),
    ),
}


def in_read_order(mart: DataFrame, name: str) -> DataFrame:
    """O1: order a mart for presentation (the physical order is the write order, S9)."""
    spec = READ_ORDER.get(name) or tuple((c, False) for c in mart.columns if c != "processed_at")
    return mart.orderBy(*[F.desc_nulls_last(c) if d else F.asc_nulls_first(c) for c, d in spec])


# --- all five marts from one scan -------------------------------------------------------------
CUBE_GRAIN = ("transaction_date", "last_status", "pos_origin", "pos_destination", "is_deleted")


def mart_cube(
    silver: DataFrame, as_of: str, threshold_hours: int = STUCK_HOURS_DEFAULT, with_stuck: bool = True
) -> DataFrame:
    """One pass over Silver: a pre-aggregate at the finest grain any mart needs
    ``(transaction_date, last_status, pos_origin, pos_destination, is_deleted)`` with composable
    measures (counts, sums, mins, maxes). All five marts roll up from it, so a build scans Bronze
    once instead of five times; the cube has at most days x statuses x routes x 2 rows.
    ``with_stuck=False`` leaves out the clock-dependent stuck-parcel measures (a cube kept across
    runs must not depend on ``as_of``)."""
    lead = hours_between("created_at", "updated_at")
    since = hours_between(F.col("updated_at"), _as_of(silver, as_of))
    stuck = (
        ~F.col("last_status").isin(*TERMINAL_STATUSES)
        & (F.col("is_deleted") == 0)
        & (since >= F.lit(int(threshold_hours)))
    )
    return (
        silver.select(
            F.to_date("created_at").alias("transaction_date"),
            "last_status",
            "pos_origin",
            "pos_destination",
            "is_deleted",
            "id",
            lead.alias("_lead"),
            F.when(stuck, since).alias("_stuck"),
        )
        .groupBy(*CUBE_GRAIN)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count("id").alias("n_id"),
            F.count("_lead").alias("lead_n"),
            F.sum("_lead").alias("lead_sum"),
            F.min("_lead").alias("lead_min"),
            F.max("_lead").alias("lead_max"),
            *(
                [
                    F.count(F.when(F.col("_stuck").isNotNull(), F.col("id"))).alias("stuck_n_id"),
                    F.count("_stuck").alias("stuck_n"),
                    F.sum("_stuck").alias("stuck_sum"),
                    F.max("_stuck").alias("stuck_max"),
                ]
                if with_stuck
                else []
            ),
        )
    )


def marts_from_cube(cube: DataFrame, as_of: str, ts_type=None) -> dict[str, DataFrame]:
    """Roll the cube up into the five marts (same columns and values as the direct functions)."""
    from pyspark.sql import types as T

    pa = ts_literal(as_of_seconds(as_of), ts_type or T.TimestampNTZType()).alias("processed_at")
    nd = F.col("is_deleted") == 0
    route = ("pos_origin", "pos_destination")
    daily = ("transaction_date", "last_status", "pos_origin", "pos_destination")

    def avg_of(s: str, n: str) -> Column:
        return round_half_even(F.try_divide(F.sum(s).cast("double"), F.sum(n).cast("double")), 2)

    m1 = (
        cube.filter(nd & (F.col("last_status") != F.lit("CANCELLED")))
        .groupBy(*daily)
        .agg(F.sum("n_id").cast("bigint").alias("total_valid_transactions"))
        .withColumn("processed_at", pa)
    )
    m2 = (
        cube.groupBy(*daily)
        .agg(
            F.sum("n_id").cast("bigint").alias("total_transactions"),
            F.sum(F.when(F.col("is_deleted") == 1, F.col("n_rows")).otherwise(0)).cast("bigint").alias("total_soft_deleted"),
        )
        .withColumn("processed_at", pa)
    )
    m3 = (
        cube.filter((F.col("last_status") == F.lit("DELIVERED")) & nd)
        .groupBy(*route)
        .agg(
            F.sum("n_id").cast("bigint").alias("total_delivered_packages"),
            avg_of("lead_sum", "lead_n").alias("avg_delivery_time_hours"),
            F.min("lead_min").alias("fastest_delivery_hours"),
            F.max("lead_max").alias("slowest_delivery_hours"),
        )
        .withColumn("processed_at", pa)
    )
    m4 = None if "stuck_n" not in cube.columns else (
        cube.filter(F.col("stuck_n") > 0)
        .groupBy("last_status", *route)
        .agg(
            F.sum("stuck_n_id").cast("bigint").alias("total_stuck_packages"),
            avg_of("stuck_sum", "stuck_n").alias("avg_hours_stuck"),
            F.max("stuck_max").alias("max_hours_stuck"),
        )
        .withColumn("processed_at", pa)
    )
    delivered = F.sum(F.when(F.col("last_status") == "DELIVERED", F.col("n_rows")).otherwise(0)).cast("bigint")
    cancelled = F.sum(F.when(F.col("last_status") == "CANCELLED", F.col("n_rows")).otherwise(0)).cast("bigint")
    total = F.sum("n_id").cast("bigint")
    m5 = (
        cube.filter(nd)
        .groupBy(*route)
        .agg(
            total.alias("total_packages"),
            delivered.alias("total_delivered"),
            cancelled.alias("total_cancelled"),
            round_half_even(pct(delivered, total), 2).alias("success_rate_pct"),
            round_half_even(pct(cancelled, total), 2).alias("cancelled_rate_pct"),
        )
        .filter(F.col("total_packages") > 0)
        .withColumn("processed_at", pa)
    )
    out = {
        "gold_daily_transaction_valid": m1,
        "gold_daily_transaction_comprehensive": m2,
        "gold_route_performance_metrics": m3,
        "gold_aging_bottleneck_alerts": m4,
        "gold_delivery_success_rate": m5,
    }
    return {k: v for k, v in out.items() if v is not None}
