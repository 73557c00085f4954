"""Extensions (E1-E4): operators the warehouse plans or implies but does not implement.

E1 status_transition_audit   illegal lifecycle moves in a change feed
E2 hard_delete_reconciliation ids still in Bronze that the source no longer has
E3 incremental_daily_mart     rebuild only the dates a batch touched
E4 aging_with_route_sla       stuck-parcel mart with a per-route threshold
(E5 lives in ``tierwise.streaming``; E6 is the run report of ``tierwise.plans.pipeline``.)
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.functions import month_key
from tierwise.operators import gold
from tierwise.operators.silver import silver_cleansed
from tierwise.schemas import LIFECYCLE_CHAIN, STATUSES, STUCK_HOURS_DEFAULT, TERMINAL_STATUSES


def broadcast_if_small(
    df: DataFrame, max_bytes: int = 128 << 20, materialize: bool = True, rows: int | None = None
) -> DataFrame:
    """Broadcast ``df`` only after checking that its rows, at their in-memory width, are at most
    ``max_bytes``; a larger side is joined with a shuffle instead. The check is a plain count (a
    partial count for each task) times the width of a row.

    ``rows``, the most rows it can have, saves the count if it is known.

    With ``materialize`` the candidate is first written once as a reliable checkpoint (shared
    checkpoint folder), so the size check and the join do not both recompute it."""
    if materialize:
        from tierwise.session import cut_lineage

        df = cut_lineage(df)
    return F.broadcast(df) if (df.count() if rows is None else rows) * row_width(df) <= max_bytes else df


def row_width(df: DataFrame) -> int:
    """Bytes of a row in a broadcast table: 32 for the entry, 8 for each fixed-width field, and 48 for
    each text (ids, cities and statuses are shorter than 40 characters)."""

    def width(kind: T.DataType) -> int:
        if isinstance(kind, T.StructType):
            return sum(width(f.dataType) for f in kind)
        return 48 if isinstance(kind, T.StringType) else 8

    return 32 + width(df.schema)


# --- E1 -------------------------------------------------------------------------------------
def legal_move(prev: Column, cur: Column) -> Column:
    """Lifecycle rule as an expression (no join): the first version must be BOOKED; afterwards the
    status stays (a touch or a soft delete), moves one step forward along the chain, or goes from
    an active state to CANCELLED."""
    active = [s for s in LIFECYCLE_CHAIN if s not in TERMINAL_STATUSES]
    nxt = F.create_map(*[F.lit(x) for pair in zip(LIFECYCLE_CHAIN[:-1], LIFECYCLE_CHAIN[1:]) for x in pair])
    # every term is made non-NULL: a missing map entry (a terminal status has no successor) or a
    # NULL status must make the move illegal, not drop it through three-valued logic
    def nn(c: Column) -> Column:
        return F.coalesce(c, F.lit(False))

    return F.when(prev.isNull(), nn(cur == F.lit("BOOKED"))).otherwise(
        nn(prev == cur) | nn(F.element_at(nxt, prev) == cur) | nn(prev.isin(*active) & (cur == F.lit("CANCELLED")))
    )


def status_transition_audit(
    changes: DataFrame, key: str = "id", ts: str = "updatedAt", seq: str = "version", status: str = "lastStatus"
) -> DataFrame:
    """Illegal moves ``(id, from_status, to_status, updated_at)`` in a change feed.

    The feed is range-partitioned by (key, time, version), so a key with a huge history, or all the versions
    without a key, is cut by time and spread over as many tasks as its size asks for. Inside a range the version before is the
    row before (``lag``); the first row of a range takes the last row of the range before it, one row for each
    range. The ranges are fixed by a reliable checkpoint before they are read twice."""
    from tierwise.session import cut_lineage

    order = [key, ts, seq, status]
    ranged = changes.select(*order).repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    feed = cut_lineage(ranged)
    before = F.lag(F.struct(*order)).over(Window.partitionBy("_range").orderBy(*order))
    # one row for each range that has rows: their order is that of the keys
    ends = feed.groupBy("_range").agg(F.max(F.struct(*order)).alias("_end"))
    carry = ends.select("_range", F.lag("_end").over(Window.orderBy("_range")).alias("_carry"))
    rows = feed.withColumn("_before", before).join(F.broadcast(carry), "_range")
    last = F.coalesce("_before", "_carry")
    # null-safe: versions without a key are one history
    prev = F.when(last.isNotNull() & last[key].eqNullSafe(F.col(key)), last[status])
    return (
        rows.withColumn("from_status", prev)
        .filter(~legal_move(F.col("from_status"), F.col(status)))
        .select(F.col(key).alias("id"), "from_status", F.col(status).alias("to_status"), F.col(ts).alias("updated_at"))
    )


# --- E2 -------------------------------------------------------------------------------------
#: Most id ranges that are compared, and most that are read by prefix (the others are filtered after the scan).
MOST_RANGES, MOST_PREFIXES = 4096, 64


def id_ranges(ids: DataFrame, key: str = "id", most: int = MOST_RANGES) -> int:
    """Length of the id prefixes that cut ``ids`` into as many ranges as possible, at most about ``most``."""
    counts = ids.agg(*[F.approx_count_distinct(F.substring(key, 1, p)).alias(str(p)) for p in range(1, 33)]).first()
    return max([p for p in range(1, 33) if counts[str(p)] <= most * 0.9], default=1)


def range_fingerprints(ids: DataFrame, prefix: int, key: str = "id") -> DataFrame:
    """(range, n, sum): count and sum of a 64-bit hash of the ids in each range. Partial aggregates: a task sends
    a row for each range it has seen."""
    return (
        ids.where(F.col(key).isNotNull())
        .groupBy(F.substring(key, 1, prefix).alias("range"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(key).cast("decimal(20,0)")).alias("sum"))
    )


def differing_ranges(bronze: DataFrame, source: DataFrame, prefix: int, key: str = "id") -> list[str]:
    """Ranges that have ids in Bronze and other ids (or none) at the source; at most about ``MOST_RANGES``."""
    b, s = (range_fingerprints(x.select(key), prefix, key) for x in (bronze, source))
    same = (b["range"] == s["range"]) & (b["n"] == s["n"]) & (b["sum"] == s["sum"])
    return sorted(r["range"] for r in b.join(s, same, "left_anti").select("range").collect())


def in_ranges(df: DataFrame, ranges: list[str], prefix: int, key: str = "id") -> DataFrame:
    """Rows of the ranges: a few are pushed to the scan as prefixes of the id, more are filtered behind it."""
    if len(ranges) > MOST_PREFIXES:
        return df.where(F.substring(key, 1, prefix).isin(ranges))
    wanted = F.lit(False)
    for r in ranges:
        # an id shorter than the prefix is a range by itself
        wanted = wanted | (F.col(key).startswith(r) if len(r) == prefix else F.col(key) == r)
    return df.where(wanted)


def hard_delete_reconciliation(bronze: DataFrame, source: DataFrame, key: str = "id") -> DataFrame:
    """Rows in Bronze whose key no longer exists at the source (hard deletes an incremental load cannot see). Rows
    without a key cannot be told to be gone and are not reported.

    Both sides are first reduced to a fingerprint for each range of ids; only the ranges that differ are read again and
    joined (anti join; AQE splits a skewed key). When few ids are gone, that is a small part of both tables;
    without a difference nothing is joined at all."""
    columns = [key, "lastStatus", "createdAt", "updatedAt", "deletedAt", "load_at"]
    prefix = id_ranges(bronze.select(key), key)
    ranges = differing_ranges(bronze, source, prefix, key)
    old, now = (in_ranges(df.select(*c), ranges, prefix, key) for df, c in ((bronze, columns), (source, [key])))
    return old.join(now, key, "left_anti").select(*columns)


# --- E3 -------------------------------------------------------------------------------------
def affected_dates(old_bronze: DataFrame, batch: DataFrame) -> DataFrame:
    """Transaction dates a batch changes: the dates of the *old* version of every changed id and of
    the new version (they differ if ``createdAt`` moved). One small column of distinct dates.

    The batch ids are broadcast to the semi join after a size check, so the old Bronze is scanned
    (pass it already restricted to the months that can hold the ids), not shuffled."""
    changed = broadcast_if_small(batch.select("id"))
    old = old_bronze.join(changed, "id", "left_semi").select(F.to_date("createdAt").alias("transaction_date"))
    new = batch.select(F.to_date("createdAt").alias("transaction_date"))
    return old.unionByName(new).distinct()


def incremental_daily_mart(
    old_mart: DataFrame,
    old_bronze: DataFrame,
    new_bronze: DataFrame,
    batch: DataFrame,
    as_of: str,
    mart_fn: Callable[[DataFrame, str], DataFrame] = gold.gold_daily_transaction_comprehensive,
) -> DataFrame:
    """A daily mart after a batch, recomputing only the affected dates: rows of untouched dates are
    kept from the old mart, affected dates are rebuilt from the new Bronze. Date matching is
    null-safe (a NULL ``createdAt`` is its own date). The date list is bounded by the calendar and is
    broadcast after a size check."""
    from tierwise.operators.load import months_filter, touched_months

    if "created_month" in old_bronze.columns:
        # stable months: an id's old version lies in its batch month (or had no month)
        old_bronze = old_bronze.filter(months_filter([*touched_months(batch), None]))
    dates = broadcast_if_small(affected_dates(old_bronze, batch))
    keep = old_mart.join(dates, old_mart["transaction_date"].eqNullSafe(dates["transaction_date"]), "left_anti")
    nb = new_bronze
    if "created_month" in nb.columns:
        # a month-partitioned Bronze: read only the months of the affected dates (partition pruning)
        months = [r[0] for r in dates.select(month_key("transaction_date").alias("m")).distinct().collect()]
        nb = nb.filter(months_filter(months))
    fresh_src = nb.join(dates, F.to_date(nb["createdAt"]).eqNullSafe(dates["transaction_date"]), "left_semi")
    fresh = mart_fn(silver_cleansed(fresh_src), as_of)
    return keep.unionByName(fresh.select(*old_mart.columns))


# --- E4 -------------------------------------------------------------------------------------
def route_sla_from_performance(route_perf: DataFrame, divisor: int = 12, lo: int = 6, hi: int = 48) -> DataFrame:
    """Per-route SLA table derived from the route lead-time mart (one row per observed route): a
    parcel counts as stuck after ``floor(avg lead time / divisor)`` hours, clamped to ``[lo, hi]``."""
    return route_perf.select(
        "pos_origin",
        "pos_destination",
        F.least(
            F.lit(hi), F.greatest(F.lit(lo), F.floor(F.col("avg_delivery_time_hours") / F.lit(divisor)))
        ).cast("int").alias("sla_hours"),
    )


def aging_with_route_sla(
    silver: DataFrame,
    sla: DataFrame,
    as_of: str,
    default_hours: int = STUCK_HOURS_DEFAULT,
) -> DataFrame:
    """The stuck-parcel mart with a per-route threshold ``coalesce(sla_hours, default)``.
    The SLA table (one row per route) is broadcast after a size check, so the large Silver side is
    never shuffled for the lookup."""
    s = broadcast_if_small(sla.selectExpr("pos_origin AS _o", "pos_destination AS _d", "sla_hours"))
    # null-safe: a route without a city has its own SLA
    same = silver["pos_origin"].eqNullSafe(s["_o"]) & silver["pos_destination"].eqNullSafe(s["_d"])
    enriched = silver.join(s, same, "left").drop("_o", "_d")
    thr = F.coalesce(F.col("sla_hours"), F.lit(int(default_hours)))
    stuck = gold.stuck_parcels(enriched, as_of, thr)
    return gold.aging_aggregate(stuck, silver, as_of)


__all__ = [
    "STATUSES",
    "affected_dates",
    "aging_with_route_sla",
    "broadcast_if_small",
    "hard_delete_reconciliation",
    "incremental_daily_mart",
    "legal_move",
    "route_sla_from_performance",
    "status_transition_audit",
]
