"""Dimension history (slowly changing dimension type 2) from a whole change log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog import schemas as S
from tidelog.functions import columns as C
from tidelog.operators.skew import HOT_ROWS, with_neighbour

HISTORY_COLUMNS = [
    "customer_sk", "customer_id", "first_name", "last_name", "email", "state",
    "valid_from", "valid_to", "is_current", "is_deleted", "_bronze_batch_id",
]


def _intervals(changes: DataFrame, hot_rows: int) -> DataFrame:
    """Every change opens an interval that the next change of the key closes."""
    images = changes.filter(f"_change_type != '{S.UPDATE_BEFORE}'")
    timed = with_neighbour(
        images, "customer_id", ["_commit_timestamp", "_row_sequence_id"], ["_commit_timestamp"], "next", "_next",
        hot_rows,
    )
    return timed.selectExpr(
        "*",
        "_commit_timestamp as valid_from",
        f"coalesce(_next_commit_timestamp, {C.END_OF_TIME}) as valid_to",
        f"cast(_next_commit_timestamp is null and _change_type != '{S.DELETE}' as int) as is_current",
        f"cast(_change_type = '{S.DELETE}' as int) as is_deleted",
    )


def _conformed(intervals: DataFrame, masked: bool) -> DataFrame:
    changed = {"state": F.expr("upper(trim(state))")}
    if masked:
        changed |= {"last_name": C.masked_last_name("last_name"), "email": C.masked_email("email")}
    return intervals.withColumns(changed)


def customer_history(staged: DataFrame, masked: bool = True, hot_rows: int = HOT_ROWS) -> DataFrame:
    """History with a tombstone row per delete and the key ``id_sequence``."""
    rows = _conformed(_intervals(staged, hot_rows), masked)
    return rows.withColumn("customer_sk", C.sequence_key("customer_id", "_row_sequence_id")).select(HISTORY_COLUMNS)


def customer_history_by_instant(
    feed: DataFrame, masked: bool = True, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The same over an unstaged mixed feed, with the key ``id_yyyyMMddHHmmss``."""
    customers = feed.filter(F.col("entity_type") == "customers")
    rows = _conformed(_intervals(customers, hot_rows), masked)
    columns = [c for c in HISTORY_COLUMNS if c != "_bronze_batch_id"]
    return rows.withColumn("customer_sk", C.second_key("customer_id", "valid_from")).select(columns)
