"""Column lists and types of the tables.

Fixed values: the column names and status values below are the data contract.
"""

from __future__ import annotations

from pyspark.sql import types as T

CHANGE_COLUMNS = ["_row_sequence_id", "entity_type", "_change_type", "_commit_timestamp"]
CUSTOMER_COLUMNS = ["customer_id", "first_name", "last_name", "email", "state", "created_at", "updated_at"]
ORDER_COLUMNS = ["order_id", "customer_id", "order_amount", "order_status", "created_at", "updated_at"]
LANDING_COLUMNS = ["_bronze_ingested_at", "_bronze_batch_id"]

ENTITY_COLUMNS = {"customers": CUSTOMER_COLUMNS, "orders": ORDER_COLUMNS}
ENTITY_KEYS = {"customers": "customer_id", "orders": "order_id"}

INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = "INSERT", "UPDATE_BEFORE", "UPDATE_AFTER", "DELETE"

ORDER_STATUSES = ["Pending", "Shipped", "Delivered", "Cancelled"]

UNKNOWN_KEY = "-1"

# columns of an event that no schema declares, as a map of name to text
EXTRA = "_extra_columns"

_TYPES = {
    "_row_sequence_id": T.LongType(),
    "order_amount": T.DoubleType(),
    "_commit_timestamp": T.TimestampNTZType(),
    "created_at": T.TimestampNTZType(),
    "updated_at": T.TimestampNTZType(),
    "_bronze_ingested_at": T.TimestampNTZType(),
    "ingest_date": T.DateType(),
    EXTRA: T.MapType(T.StringType(), T.StringType()),
}


def struct_of(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, _TYPES.get(c, T.StringType())) for c in columns])


def landed_columns(entity: str) -> list[str]:
    return CHANGE_COLUMNS + ENTITY_COLUMNS[entity] + LANDING_COLUMNS


CHANGE_LOG_SCHEMA = struct_of(
    CHANGE_COLUMNS + CUSTOMER_COLUMNS[:5] + ["order_id", "order_amount", "order_status", "created_at", "updated_at", "loyalty_tier"]
)

DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("entity_type", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("record", T.StringType()),
        T.StructField("quarantined_at", T.TimestampNTZType()),
    ]
)

RUN_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("at", T.TimestampNTZType()),
        T.StructField("records_processed", T.LongType()),
        T.StructField("error_message", T.StringType()),
    ]
)

LANDED_SCHEMA = T.StructType(
    [
        T.StructField("entity_type", T.StringType()),
        T.StructField("ingest_date", T.DateType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("first_id", T.LongType()),
        T.StructField("last_id", T.LongType()),
        T.StructField("columns", T.ArrayType(T.StringType())),
        T.StructField("landed_at", T.TimestampNTZType()),
    ]
)

APPLIED_SCHEMA = T.StructType(
    [
        T.StructField("_bronze_batch_id", T.StringType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("applied_at", T.TimestampNTZType()),
    ]
)

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("log_id", T.StringType()),
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("target_table", T.StringType()),
        T.StructField("records_processed", T.LongType()),
        T.StructField("records_quarantined", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("start_time", T.TimestampNTZType()),
        T.StructField("end_time", T.TimestampNTZType()),
        T.StructField("duration_seconds", T.DoubleType()),
    ]
)
