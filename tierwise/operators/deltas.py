"""Gold kept up to date by signed counts: a load adds +1 for every new version and -1 for every version it
replaces, and reads nothing else.

All five marts follow from three tables of counts, each a sum and so open to subtraction:

* ``daily``: rows by (transaction date, status, route, deleted flag): the daily marts and the success rate;
* ``lead``: delivered, not deleted parcels by (route, lead hours). Minimum, maximum and mean lead time are read
  off the hours that still count, so they stay right when parcels leave (a soft delete of the fastest parcel);
* ``active``: parcels under way by (status, route, hour of the last update). The clock is not part of it: the stuck
  parcels at any ``as_of``, with any threshold by route, are the counts up to an hour.

Every count has two measures, rows and rows with an id (the marts count ids). A key whose counts are zero is gone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.functions import as_of_seconds, hour_index, hours_between, pct, round_half_even, ts_literal
from tierwise.operators.extensions import broadcast_if_small
from tierwise.operators.silver import silver_cleansed
from tierwise.schemas import AGING_GRAIN, BRONZE_COLUMNS, DAILY_GRAIN, ROUTE_GRAIN, STUCK_HOURS_DEFAULT, TERMINAL_STATUSES

GRAINS = {
    "daily": (*DAILY_GRAIN, "is_deleted"),
    "lead": (*ROUTE_GRAIN, "hours"),
    "active": (*AGING_GRAIN, "hours"),
}
#: The finest grain: the three tables roll up from it. ``hours``: lead hours of delivered parcels, hour of the last
#: update of active ones, null for the rest.
FINEST = (*DAILY_GRAIN, "is_deleted", "hours")
MEASURES = ("n_rows", "n_id")


def signed_changes(old_bronze: DataFrame, batch: DataFrame, batch_rows: int | None = None) -> DataFrame:
    """The batch's rows with ``_sign`` +1 and the stored versions they replace with -1 (Bronze columns).

    Pass the old Bronze restricted to the months that can hold the batch's ids: it is scanned and semi-joined
    with the batch's ids (broadcast if their checked size allows), not shuffled. Rows without an id replace
    nothing, as in the upsert."""
    ids = broadcast_if_small(batch.select("id"), materialize=False, rows=batch_rows)
    gone = old_bronze.select(*BRONZE_COLUMNS).join(ids, "id", "left_semi").select("*", F.lit(-1).alias("_sign"))
    return batch.select(*BRONZE_COLUMNS, F.lit(1).alias("_sign")).unionByName(gone)


def finest_counts(rows: DataFrame, silver=silver_cleansed) -> DataFrame:
    """One pass over Bronze rows (``_sign`` if they have it, else +1): counts by ``FINEST``."""
    signed = "_sign" in rows.columns
    s = silver(rows, ("_sign",) if signed else ())
    sign = F.col("_sign") if signed else F.lit(1)
    here = F.col("is_deleted") == 0
    hours = F.when(here & (F.col("last_status") == "DELIVERED"), hours_between("created_at", "updated_at")).when(
        here & ~F.col("last_status").isin(*TERMINAL_STATUSES), hour_index("updated_at")
    )
    keyed = s.select(
        F.to_date("created_at").alias("transaction_date"), "last_status", "pos_origin", "pos_destination", "is_deleted",
        hours.alias("hours"), sign.alias("_s"), F.when(F.col("id").isNotNull(), sign).otherwise(0).alias("_i"),
    )
    return _summed(keyed.withColumnsRenamed({"_s": "n_rows", "_i": "n_id"}), FINEST)


def _summed(counts: DataFrame, grain: tuple[str, ...]) -> DataFrame:
    out = counts.groupBy(*grain).agg(*[F.sum(m).cast("bigint").alias(m) for m in MEASURES])
    return out.where("n_rows <> 0 OR n_id <> 0")


def roll_up(finest: DataFrame) -> dict[str, DataFrame]:
    """The three tables of ``GRAINS`` from the finest counts."""
    here = F.col("is_deleted") == 0
    return {
        "daily": _summed(finest, GRAINS["daily"]),
        "lead": _summed(finest.where(here & (F.col("last_status") == "DELIVERED")), GRAINS["lead"]),
        "active": _summed(finest.where(here & ~F.col("last_status").isin(*TERMINAL_STATUSES)), GRAINS["active"]),
    }


def merged(name: str, *parts: DataFrame) -> DataFrame:
    """Counts of one table, summed over its parts (a base and the deltas of later loads)."""
    out = parts[0].select(*GRAINS[name], *MEASURES)
    for p in parts[1:]:
        out = out.unionByName(p.select(*GRAINS[name], *MEASURES))
    return _summed(out, GRAINS[name])


# --- the marts -----------------------------------------------------------------------------------
def _stamp(as_of: str, kind: T.DataType | None) -> Column:
    return ts_literal(as_of_seconds(as_of), kind or T.TimestampNTZType()).alias("processed_at")


def _total(measure: str, where: Column | None = None) -> Column:
    value = F.col(measure) if where is None else F.when(where, F.col(measure)).otherwise(0)
    return F.sum(value).cast("bigint")


def daily_valid(daily: DataFrame, as_of: str, kind: T.DataType | None = None) -> DataFrame:
    """M1 from ``daily``, whose keys may be there several times (a base and its deltas)."""
    rows = daily.where((F.col("is_deleted") == 0) & (F.col("last_status") != "CANCELLED"))
    sums = rows.groupBy(*DAILY_GRAIN).agg(_total("n_id").alias("total_valid_transactions"), _total("n_rows").alias("_rows"))
    return sums.where("total_valid_transactions <> 0 OR _rows <> 0").drop("_rows").withColumn("processed_at", _stamp(as_of, kind))


def daily_comprehensive(daily: DataFrame, as_of: str, kind: T.DataType | None = None) -> DataFrame:
    """M2 from ``daily``, whose keys may be there several times (a base and its deltas)."""
    gone = F.col("is_deleted") == 1
    # a date, status and route is left out if neither its deleted rows nor the others count any more
    counted = {"_gone_id": _total("n_id", gone), "_rows": _total("n_rows", ~gone), "_id": _total("n_id", ~gone)}
    return (
        daily.groupBy(*DAILY_GRAIN)
        .agg(
            _total("n_id").alias("total_transactions"), _total("n_rows", gone).alias("total_soft_deleted"),
            *[c.alias(k) for k, c in counted.items()],
        )
        .where(" OR ".join(f"{c} <> 0" for c in ("total_soft_deleted", *counted)))
        .drop(*counted)
        .withColumn("processed_at", _stamp(as_of, kind))
    )


def daily_mart_after(
    old_mart: DataFrame, daily: DataFrame, changes: DataFrame, as_of: str, mart=daily_comprehensive
) -> DataFrame:
    """E3: a daily mart after a load. ``daily`` are the counts before it, ``changes`` its signed rows. Dates that the
    load touches are summed anew from counts; rows of all other dates stay as they are in ``old_mart``, stamp
    included. Dates match null-safely; the list of dates is bounded by the calendar and its size is checked."""
    dates = broadcast_if_small(changes.select(F.to_date("createdAt").alias("_date")).distinct())

    def on(df: DataFrame, how: str) -> DataFrame:
        return df.join(dates, df["transaction_date"].eqNullSafe(dates["_date"]), how)

    delta = roll_up(finest_counts(changes))["daily"]
    fresh = mart(merged("daily", on(daily, "left_semi"), delta), as_of, old_mart.schema["processed_at"].dataType)
    return on(old_mart, "left_anti").unionByName(fresh.select(*old_mart.columns))


def _mean(value: Column, weight: str) -> Column:
    known = F.when(value.isNotNull(), F.col(weight)).otherwise(0)
    return round_half_even(F.try_divide(F.sum(value * F.col(weight)).cast("double"), F.sum(known).cast("double")), 2)


def route_performance(lead: DataFrame, as_of: str, kind: T.DataType | None = None) -> DataFrame:
    """M3 from ``lead``: extremes over the hours that still have parcels, so nothing has to be remembered of those
    that left."""
    return (
        lead.where("n_rows > 0")
        .groupBy(*ROUTE_GRAIN)
        .agg(
            _total("n_id").alias("total_delivered_packages"),
            _mean(F.col("hours"), "n_rows").alias("avg_delivery_time_hours"),
            F.min("hours").alias("fastest_delivery_hours"),
            F.max("hours").alias("slowest_delivery_hours"),
        )
        .withColumn("processed_at", _stamp(as_of, kind))
    )


def aging_alerts(
    active: DataFrame, as_of: str, threshold: Column | int = STUCK_HOURS_DEFAULT, kind: T.DataType | None = None
) -> DataFrame:
    """M4 from ``active``: counts whose last update lies ``threshold`` hour boundaries or more before ``as_of``. The
    threshold may be a column of ``active`` (E4)."""
    now = hour_index(ts_literal(as_of_seconds(as_of), kind or T.TimestampNTZType()))
    stuck = (now - F.col("hours")).alias("_stuck")
    least = threshold if isinstance(threshold, Column) else F.lit(int(threshold))
    return (
        active.where("n_rows > 0")
        .where(stuck >= least)
        .groupBy(*AGING_GRAIN)
        .agg(
            _total("n_id").alias("total_stuck_packages"),
            _mean(stuck, "n_rows").alias("avg_hours_stuck"),
            F.max(stuck).alias("max_hours_stuck"),
        )
        .withColumn("processed_at", _stamp(as_of, kind))
    )


def aging_alerts_by_sla(
    active: DataFrame, sla: DataFrame, as_of: str, default_hours: int = STUCK_HOURS_DEFAULT, kind: T.DataType | None = None
) -> DataFrame:
    """E4 from ``active``: a threshold for each route (null-safe), the default for routes without one."""
    s = broadcast_if_small(sla.selectExpr("pos_origin AS _o", "pos_destination AS _d", "sla_hours"))
    same = active["pos_origin"].eqNullSafe(s["_o"]) & active["pos_destination"].eqNullSafe(s["_d"])
    return aging_alerts(active.join(s, same, "left"), as_of, F.coalesce(F.col("sla_hours"), F.lit(int(default_hours))), kind)


def success_rate(daily: DataFrame, as_of: str, kind: T.DataType | None = None) -> DataFrame:
    """M5 from ``daily``, whose keys may be there several times (a base and its deltas)."""
    total = _total("n_id")
    delivered = _total("n_rows", F.col("last_status") == "DELIVERED")
    cancelled = _total("n_rows", F.col("last_status") == "CANCELLED")
    return (
        daily.where("is_deleted = 0")
        .groupBy(*ROUTE_GRAIN)
        .agg(
            total.alias("total_packages"),
            delivered.alias("total_delivered"),
            cancelled.alias("total_cancelled"),
            round_half_even(pct(delivered, total), 2).alias("success_rate_pct"),
            round_half_even(pct(cancelled, total), 2).alias("cancelled_rate_pct"),
        )
        .where("total_packages > 0")
        .withColumn("processed_at", _stamp(as_of, kind))
    )


def marts(counts: dict[str, DataFrame], as_of: str, kind: T.DataType | None = None) -> dict[str, DataFrame]:
    """The five marts (columns and values as ``gold.MARTS`` over the rows that were counted). ``daily`` need not be
    ``merged``: the marts from it are sums."""
    return {
        "gold_daily_transaction_valid": daily_valid(counts["daily"], as_of, kind),
        "gold_daily_transaction_comprehensive": daily_comprehensive(counts["daily"], as_of, kind),
        "gold_route_performance_metrics": route_performance(counts["lead"], as_of, kind),
        "gold_aging_bottleneck_alerts": aging_alerts(counts["active"], as_of, kind=kind),
        "gold_delivery_success_rate": success_rate(counts["daily"], as_of, kind),
    }
