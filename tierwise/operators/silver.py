"""P2 Silver: the single cleansing projection over Bronze (a lazy view; Catalyst inlines it)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def silver_cleansed(bronze: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """camelCase -> snake_case, ``trim`` (spaces only) on the text columns, ``upper(trim(.))`` on the
    status and ``is_deleted`` = 1 exactly when ``deletedAt`` is set (an int flag, never NULL). ``keep``
    names Bronze columns to carry along (the partition column, for pruned checks)."""
    return bronze.selectExpr(
        "trim(id) AS id",
        "trim(customerId) AS customer_id",
        "upper(trim(lastStatus)) AS last_status",
        "trim(posOrigin) AS pos_origin",
        "trim(posDestination) AS pos_destination",
        "createdAt AS created_at",
        "updatedAt AS updated_at",
        "deletedAt AS deleted_at",
        "load_at",
        "CAST(CASE WHEN deletedAt IS NOT NULL THEN 1 ELSE 0 END AS INT) AS is_deleted",
        *keep,
    )
