"""Q1-Q8 data-quality operators. A check returns a DataFrame of violations (empty = pass);
``summarise`` turns a set of checks into ``(model, test_name, column_name, failures)`` rows.

Failure counts follow the usual convention for "a test is a query whose rows are failures":
``unique`` counts duplicated values, ``not_null`` counts NULL rows, ``accepted_values`` counts
distinct unexpected values, a singular test counts its rows.

Null counts for many columns run as **one** aggregate pass; the rest are filters or grouped counts
(partial aggregation before the shuffle), so no check gathers a group into one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tierwise.schemas import DAILY_GRAIN


# --- Q1 -----------------------------------------------------------------------------------
def dq_unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values of ``column`` that occur more than once: ``(value, n_records)``."""
    return (
        df.select(F.col(column).alias("value"))
        .filter(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


# --- Q2 -----------------------------------------------------------------------------------
def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL rows per column in one scan: ``(column_name, failures)`` (one row per column)."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in columns])
    return agg.unpivot([], list(columns), "column_name", "failures")


def dq_not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows where ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


# --- Q3 -----------------------------------------------------------------------------------
def dq_accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Values outside ``values`` (NULL passes): ``(value, n_records)``, one row per bad value."""
    vals = list(values)
    return (
        df.select(F.col(column).alias("value"))
        .filter(F.col("value").isNotNull() & ~F.col("value").isin(*vals))
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


# --- Q4 -----------------------------------------------------------------------------------
def dq_is_deleted_consistent(silver: DataFrame) -> DataFrame:
    """``is_deleted`` must be 1 exactly when ``deleted_at`` is set."""
    d, f = F.col("deleted_at"), F.col("is_deleted")
    bad = (d.isNotNull() & (f != F.lit(1))) | (d.isNull() & (f != F.lit(0)))
    return silver.filter(bad).select("id", "deleted_at", "is_deleted")


# --- Q5 -----------------------------------------------------------------------------------
def dq_daily_grain_unique(valid: DataFrame, comprehensive: DataFrame) -> DataFrame:
    """Grain rows that occur more than once in either daily mart, tagged with the mart name."""

    def dupes(df: DataFrame, name: str) -> DataFrame:
        return (
            df.groupBy(*DAILY_GRAIN)
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1)
            .select(F.lit(name).alias("model_name"), *DAILY_GRAIN, "n_rows")
        )

    return dupes(valid, "gold_daily_transaction_valid").unionByName(
        dupes(comprehensive, "gold_daily_transaction_comprehensive")
    )


# --- Q6 -----------------------------------------------------------------------------------
def dq_route_lead_time_valid(route: DataFrame) -> DataFrame:
    """Negative lead times, or slowest < fastest."""
    bad = (
        (F.col("fastest_delivery_hours") < 0)
        | (F.col("avg_delivery_time_hours") < 0)
        | (F.col("slowest_delivery_hours") < F.col("fastest_delivery_hours"))
    )
    return route.filter(bad).select(
        "pos_origin",
        "pos_destination",
        "fastest_delivery_hours",
        "avg_delivery_time_hours",
        "slowest_delivery_hours",
    )


# --- Q7 -----------------------------------------------------------------------------------
def dq_success_rate_bounds(success: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Each rate within 0..100 and their sum at most 100 + ``tolerance``."""
    s, c = F.col("success_rate_pct"), F.col("cancelled_rate_pct")
    bad = (s < 0) | (s > 100) | (c < 0) | (c > 100) | ((s + c) > F.lit(100.0 + tolerance))
    return success.filter(bad).select("pos_origin", "pos_destination", "success_rate_pct", "cancelled_rate_pct")


# --- Q8 -----------------------------------------------------------------------------------
@dataclass(frozen=True)
class Check:
    model: str
    test_name: str
    column_name: str | None
    violations: DataFrame  # rows = failures

    def failures(self) -> DataFrame:
        """One row ``(model, test_name, column_name, failures)``."""
        return self.violations.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
            F.lit(self.model).alias("model"),
            F.lit(self.test_name).alias("test_name"),
            F.lit(self.column_name).cast("string").alias("column_name"),
            "failures",
        )


def summarise(checks: Sequence[Check]) -> DataFrame:
    """Union of one-row failure counts; NULL counts of one model share one scan."""
    parts: list[DataFrame] = []
    not_null_by_model: dict[str, tuple[DataFrame, list[str]]] = {}
    for ch in checks:
        if ch.test_name == "not_null" and ch.column_name is not None:
            src, cols = not_null_by_model.setdefault(ch.model, (ch.violations, []))
            cols.append(ch.column_name)
        else:
            parts.append(ch.failures())
    for model, (df, cols) in not_null_by_model.items():
        parts.append(
            null_counts(df, cols).select(
                F.lit(model).alias("model"),
                F.lit("not_null").alias("test_name"),
                F.col("column_name").cast("string").alias("column_name"),
                F.col("failures").cast("bigint").alias("failures"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def not_null_check(model: str, df: DataFrame, column: str) -> Check:
    """A not-null check keeps the *table* so ``summarise`` can fuse the null counts of a model."""
    return Check(model, "not_null", column, df)


def _layer_checks(layers: dict[str, DataFrame], statuses: Sequence[str]) -> list[Check]:
    """The 10 Bronze/Silver column tests (2 unique, 5 not_null, 3 accepted_values)."""
    b = layers["bronze_retail_transactions"]
    s = layers["silver_retail_transactions_cleansed"]
    return [
        Check("bronze_retail_transactions", "unique", "id", dq_unique(b, "id")),
        not_null_check("bronze_retail_transactions", b, "id"),
        not_null_check("bronze_retail_transactions", b, "lastStatus"),
        Check(
            "bronze_retail_transactions",
            "accepted_values",
            "lastStatus",
            dq_accepted_values(b, "lastStatus", statuses),
        ),
        Check("silver_retail_transactions_cleansed", "unique", "id", dq_unique(s, "id")),
        not_null_check("silver_retail_transactions_cleansed", s, "id"),
        not_null_check("silver_retail_transactions_cleansed", s, "last_status"),
        Check(
            "silver_retail_transactions_cleansed",
            "accepted_values",
            "last_status",
            dq_accepted_values(s, "last_status", statuses),
        ),
        not_null_check("silver_retail_transactions_cleansed", s, "is_deleted"),
        Check(
            "silver_retail_transactions_cleansed",
            "accepted_values",
            "is_deleted",
            dq_accepted_values(s, "is_deleted", (0, 1)),
        ),
    ]


GOLD_NOT_NULL = {
    "gold_daily_transaction_comprehensive": ("transaction_date", "total_transactions", "total_soft_deleted"),
    "gold_daily_transaction_valid": ("transaction_date", "total_valid_transactions"),
    "gold_route_performance_metrics": ("pos_origin", "avg_delivery_time_hours"),
    "gold_aging_bottleneck_alerts": ("total_stuck_packages",),
    "gold_delivery_success_rate": ("success_rate_pct",),
}


def generic_checks(layers: dict[str, DataFrame], statuses: Sequence[str], only_gold: bool = False) -> list[Check]:
    """The 19 column tests declared for the warehouse (2 unique, 14 not_null, 3 accepted_values);
    ``only_gold`` builds just the 9 mart tests (checks are DataFrames: only build what runs)."""
    out = [] if only_gold else _layer_checks(layers, statuses)
    for model, cols in GOLD_NOT_NULL.items():
        if model in layers:
            out.extend(not_null_check(model, layers[model], c) for c in cols)
    return out


def singular_checks(layers: dict[str, DataFrame]) -> list[Check]:
    """The four invariant tests."""
    out = []
    if "silver_retail_transactions_cleansed" in layers:
        out.append(
            Check(
                "silver_retail_transactions_cleansed",
                "assert_silver_is_deleted_consistent",
                None,
                dq_is_deleted_consistent(layers["silver_retail_transactions_cleansed"]),
            )
        )
    if "gold_daily_transaction_valid" in layers and "gold_daily_transaction_comprehensive" in layers:
        out.append(
            Check(
                "gold_daily_transaction_valid+gold_daily_transaction_comprehensive",
                "assert_gold_daily_grain_unique",
                None,
                dq_daily_grain_unique(
                    layers["gold_daily_transaction_valid"], layers["gold_daily_transaction_comprehensive"]
                ),
            )
        )
    if "gold_route_performance_metrics" in layers:
        out.append(
            Check(
                "gold_route_performance_metrics",
                "assert_route_lead_time_valid",
                None,
                dq_route_lead_time_valid(layers["gold_route_performance_metrics"]),
            )
        )
    if "gold_delivery_success_rate" in layers:
        out.append(
            Check(
                "gold_delivery_success_rate",
                "assert_success_rate_within_bounds",
                None,
                dq_success_rate_bounds(layers["gold_delivery_success_rate"]),
            )
        )
    return out


def unique_ids(tables: dict[str, DataFrame], column: str = "id") -> DataFrame:
    """``unique`` on ``column`` of each table: ``(model, test_name, column_name, failures)``.

    Rows are counted per id with a partial aggregate before the shuffle, so an id that holds a third
    of all rows (a duplication bug upstream) is collapsed in the tasks that read it."""
    parts = [
        dq_unique(df, column).agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
            F.lit(model).alias("model"),
            F.lit("unique").alias("test_name"),
            F.lit(column).cast("string").alias("column_name"),
            "failures",
        )
        for model, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _rows(totals: DataFrame, spec: Sequence[tuple[str, str, str | None, str]]) -> DataFrame:
    """One-row totals as check rows: (model, test_name, column_name, column of the total)."""
    rows = F.array(
        *[
            F.struct(
                F.lit(m).alias("model"),
                F.lit(t).alias("test_name"),
                F.lit(c).cast("string").alias("column_name"),
                F.coalesce(F.col(v), F.lit(0)).cast("bigint").alias("failures"),
            )
            for m, t, c, v in spec
        ]
    )
    return totals.select(F.explode(rows).alias("r")).select("r.*")


def _outside(column: Column, values: Sequence) -> Column:
    return F.count_distinct(F.when(column.isNotNull() & ~column.isin(*values), column))


def row_checks(
    bronze: DataFrame, silver: DataFrame, bronze_model: str, silver_model: str, statuses: Sequence[str]
) -> DataFrame:
    """The row-level generic checks of Bronze and Silver (not_null x5, accepted_values x3) and the
    Silver ``is_deleted`` consistency test: one scan of each table.

    Each table is first reduced to counts by (status, flag), a handful of groups with partial
    aggregation before the shuffle; every total is read off those."""
    vals = list(statuses)
    b = bronze.groupBy(F.col("lastStatus").alias("status")).agg(
        F.count_if(F.col("id").isNull()).alias("id_null"), F.count(F.lit(1)).alias("n")
    )
    b = b.agg(
        F.sum("id_null").alias("id_null"),
        F.sum(F.when(F.col("status").isNull(), F.col("n")).otherwise(0)).alias("status_null"),
        _outside(F.col("status"), vals).alias("status_bad"),
    )
    wrong = (F.col("deleted_at").isNotNull() & (F.col("is_deleted") != 1)) | (
        F.col("deleted_at").isNull() & (F.col("is_deleted") != 0)
    )
    s = silver.groupBy(F.col("last_status").alias("status"), F.col("is_deleted").alias("flag")).agg(
        F.count_if(F.col("id").isNull()).alias("id_null"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(wrong).alias("flag_wrong"),
    )
    s = s.agg(
        F.sum("id_null").alias("id_null"),
        F.sum(F.when(F.col("status").isNull(), F.col("n")).otherwise(0)).alias("status_null"),
        _outside(F.col("status"), vals).alias("status_bad"),
        F.sum(F.when(F.col("flag").isNull(), F.col("n")).otherwise(0)).alias("flag_null"),
        _outside(F.col("flag"), (0, 1)).alias("flag_bad"),
        F.sum("flag_wrong").alias("flag_wrong"),
    )
    return _rows(
        b,
        [
            (bronze_model, "not_null", "id", "id_null"),
            (bronze_model, "not_null", "lastStatus", "status_null"),
            (bronze_model, "accepted_values", "lastStatus", "status_bad"),
        ],
    ).unionByName(
        _rows(
            s,
            [
                (silver_model, "not_null", "id", "id_null"),
                (silver_model, "not_null", "last_status", "status_null"),
                (silver_model, "accepted_values", "last_status", "status_bad"),
                (silver_model, "not_null", "is_deleted", "flag_null"),
                (silver_model, "accepted_values", "is_deleted", "flag_bad"),
                (silver_model, "assert_silver_is_deleted_consistent", None, "flag_wrong"),
            ],
        )
    )


def layer_checks(
    bronze: DataFrame, silver: DataFrame, bronze_model: str, silver_model: str, statuses: Sequence[str]
) -> DataFrame:
    """All Bronze and Silver checks over the tables given."""
    return row_checks(bronze, silver, bronze_model, silver_model, statuses).unionByName(
        unique_ids({bronze_model: bronze, silver_model: silver})
    )


def incremental_layer_checks(
    bronze: DataFrame,
    silver: DataFrame,
    batch: DataFrame,
    months: Sequence[int | None],
    bronze_model: str,
    silver_model: str,
    statuses: Sequence[str],
    batch_rows: int | None = None,
    unique_in: Sequence[str] | None = None,
) -> DataFrame:
    """Bronze/Silver checks of one load, given that the tables passed them before the load.

    A load only rewrites the months of its batch, so row-level checks read those months only
    (partition pruning on ``created_month``, which Silver must carry too). Uniqueness can only break
    for ids that share a trimmed value with a batch id, so it runs over the rows semi-joined to the
    batch's trimmed ids (broadcast after a size check, shuffled otherwise). ``unique_in``: the rows were
    watched while they were written (``LayerWatch``), so only the uniqueness in these models is asked for."""
    from tierwise.functions import clean_text
    from tierwise.operators.extensions import broadcast_if_small
    from tierwise.operators.load import months_filter

    ids = batch.select(clean_text("id").alias("_bt")).filter(F.col("_bt").isNotNull()).distinct()
    keys = broadcast_if_small(ids, materialize=batch_rows is None, rows=batch_rows)

    def related(df: DataFrame) -> DataFrame:
        return df.join(keys, clean_text(df["id"]) == keys["_bt"], "left_semi")

    touched = months_filter(months)
    layers = {bronze_model: bronze, silver_model: silver}
    unique = unique_ids({m: related(df) for m, df in layers.items() if unique_in is None or m in unique_in})
    if unique_in is not None:
        return unique
    return row_checks(bronze.filter(touched), silver.filter(touched), bronze_model, silver_model, statuses).unionByName(unique)


class LayerWatch:
    """The row checks of Bronze and Silver (``row_checks``) as observed metrics of the rows while they are written.

    Called with Bronze rows, it returns them with an observation of themselves and of the Silver rows that
    ``silver`` makes of them. After the write ``clean`` tells whether every count is zero. Where it is not, the
    checks are run over the written months: they count distinct values, which cannot be observed."""

    def __init__(self, silver: Callable[..., DataFrame], statuses: Sequence[str]):
        self.silver, self.statuses = silver, list(statuses)
        self.seen = Observation(f"layers-{uuid.uuid4().hex}")

    def __call__(self, bronze: DataFrame) -> DataFrame:
        both = self.silver(bronze, ("struct(*) AS _raw",))
        raw, flag, status = F.col("_raw"), F.col("is_deleted"), F.col("last_status")
        outside = status.isNull() | ~status.isin(*self.statuses)
        raw_outside = raw["lastStatus"].isNull() | ~raw["lastStatus"].isin(*self.statuses)
        wrong = flag.isNull() | (flag != F.when(F.col("deleted_at").isNotNull(), 1).otherwise(0))
        notes = {"raw_id": raw["id"].isNull(), "raw_status": raw_outside, "id": F.col("id").isNull(), "status": outside, "flag": wrong}
        watched = both.observe(self.seen, *[F.count_if(c).alias(k) for k, c in notes.items()])
        return watched.select(*[raw[c].alias(c) for c in bronze.columns])

    @property
    def clean(self) -> bool:
        return not any(self.seen.get.values())


def dq_suite_summary(layers: dict[str, DataFrame], statuses: Sequence[str]) -> DataFrame:
    """All 23 checks (19 generic + 4 singular) as ``(model, test_name, column_name, failures)``, over the
    tables of ``layers``: Silver's checks read Silver."""
    b, s = "bronze_retail_transactions", "silver_retail_transactions_cleansed"
    gold_layers = {k: v for k, v in layers.items() if k not in (b, s)}
    gold_checks = generic_checks(layers, statuses, only_gold=True) + singular_checks(gold_layers)
    layer_rows = layer_checks(layers[b], layers[s], b, s, statuses)
    return layer_rows.unionByName(summarise(gold_checks)) if gold_checks else layer_rows
