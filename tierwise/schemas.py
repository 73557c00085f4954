"""Fixed schemas per layer and the domain's fixed value lists."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the source system's) -------------------------------------
# Parcel lifecycle statuses, in lifecycle order.
STATUSES = ("BOOKED", "PROCESSING", "IN_TRANSIT", "OUT_FOR_DELIVERY", "DELIVERED", "CANCELLED")
# Forward chain of the lifecycle (CANCELLED is reachable from every active state).
LIFECYCLE_CHAIN = ("BOOKED", "PROCESSING", "IN_TRANSIT", "OUT_FOR_DELIVERY", "DELIVERED")
# Terminal statuses: a parcel in one of these can no longer be "stuck".
TERMINAL_STATUSES = ("DELIVERED", "CANCELLED")
DELETED_FLAG_VALUES = (0, 1)
# Default threshold (hours) after which an active parcel counts as stuck.
STUCK_HOURS_DEFAULT = 12
# ----------------------------------------------------------------------------------------

SOURCE_COLUMNS = (
    "id",
    "customerId",
    "lastStatus",
    "posOrigin",
    "posDestination",
    "createdAt",
    "updatedAt",
    "deletedAt",
)


def source_schema(ts_type: T.DataType | None = None) -> T.StructType:
    """Operational ``retail_transactions`` table. ``ts_type`` is ``TimestampType`` for a zoned
    source (JDBC ``timestamptz``) and ``TimestampNTZType`` for zone-free files."""
    ts = ts_type or T.TimestampNTZType()
    return T.StructType(
        [
            T.StructField("id", T.StringType(), False),
            T.StructField("customerId", T.StringType(), True),
            T.StructField("lastStatus", T.StringType(), True),
            T.StructField("posOrigin", T.StringType(), True),
            T.StructField("posDestination", T.StringType(), True),
            T.StructField("createdAt", ts, True),
            T.StructField("updatedAt", ts, True),
            T.StructField("deletedAt", ts, True),
        ]
    )


BRONZE_COLUMNS = SOURCE_COLUMNS + ("load_at",)
# Physical partition column of Bronze (calendar month of createdAt, yyyymm).
BRONZE_PARTITION = "created_month"

SILVER_COLUMNS = (
    "id",
    "customer_id",
    "last_status",
    "pos_origin",
    "pos_destination",
    "created_at",
    "updated_at",
    "deleted_at",
    "load_at",
    "is_deleted",
)

DAILY_GRAIN = ("transaction_date", "last_status", "pos_origin", "pos_destination")
ROUTE_GRAIN = ("pos_origin", "pos_destination")
AGING_GRAIN = ("last_status", "pos_origin", "pos_destination")

# Physical write order per table (sorted files give min/max skipping in Parquet).
WRITE_ORDER = {
    "bronze_retail_transactions": ("updated_date", "lastStatus", "id"),
    "gold_daily_transaction_valid": ("transaction_date", "last_status"),
    "gold_daily_transaction_comprehensive": ("transaction_date", "last_status"),
    "gold_route_performance_metrics": ("pos_origin", "pos_destination"),
    "gold_delivery_success_rate": ("pos_origin", "pos_destination"),
    "gold_aging_bottleneck_alerts": ("last_status", "pos_origin"),
}
