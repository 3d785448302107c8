"""Latest state per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog import schemas as S


def latest_per_key(changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The last row of each key.

    Spark limits each window group before the shuffle, so a hot key sends one row
    per task, not all of its rows.
    """
    newest_first = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order])
    return changes.withColumn("_rn", F.row_number().over(newest_first)).filter("_rn = 1").drop("_rn")


def current_orders(staged: DataFrame) -> DataFrame:
    """Orders as their last change left them; a delete removes the order."""
    last = latest_per_key(staged, "order_id", ["_commit_timestamp", "_row_sequence_id"])
    return last.filter(F.col("_change_type") != S.DELETE).select(
        "order_id", "customer_id", F.col("order_amount").cast("double"), "order_status",
        "created_at", "updated_at", "_bronze_batch_id",
    )
