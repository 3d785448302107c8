"""The star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog import schemas as S
from tidelog.functions import columns as C
from tidelog.operators.asof import asof_versions
from tidelog.operators.skew import HOT_ROWS, kept, spread_lookup

DIM_COLUMNS = [
    "customer_sk", "customer_id", "first_name", "last_name", "email", "state", "valid_from", "valid_to", "is_current",
]


def unknown_member(history: DataFrame) -> DataFrame:
    """The one row facts without a customer version point to; its values are fixed."""
    return history.sparkSession.range(1).select(
        F.lit(S.UNKNOWN_KEY).alias("customer_sk"),
        F.lit("unknown").alias("customer_id"),
        F.lit("Unknown").alias("first_name"),
        F.lit("Customer").alias("last_name"),
        F.lit("unknown@example.com").alias("email"),
        F.lit("UNKNOWN").alias("state"),
        C.start_of_time().alias("valid_from"),
        C.end_of_time().alias("valid_to"),
        F.lit(1).alias("is_current"),
    )


def customer_dimension(history: DataFrame) -> DataFrame:
    """Every version that is no tombstone, and the unknown member."""
    return unknown_member(history).unionByName(history.filter("is_deleted = 0").select(DIM_COLUMNS))


def current_customers(history: DataFrame) -> DataFrame:
    return history.filter("is_current = 1 and is_deleted = 0")


def order_facts(orders: DataFrame, dimension: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Orders with the key of the customer version valid when they were created."""
    resolved = asof_versions(
        orders.select("order_id", "customer_id", "order_amount", "order_status", "created_at"),
        dimension, "customer_id", "created_at", ["customer_sk"], hot_rows,
    )
    return resolved.select(
        "order_id",
        F.coalesce("customer_sk", F.lit(S.UNKNOWN_KEY)).alias("customer_sk"),
        C.date_key("created_at").alias("date_key"),
        "order_amount", "order_status", "created_at",
    )


def order_facts_by_commit(orders: DataFrame, history: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Orders with the customer that had a version at their commit time, both ends of an interval included.

    The key is the customer's own id, NULL where none matches; an order on the
    border of two versions gives two rows.
    """
    versions = history.withColumn("_matched", F.col("customer_id"))
    facts = asof_versions(
        orders.select("order_id", "customer_id", "order_amount", "order_status", "_commit_timestamp"),
        versions, "customer_id", "_commit_timestamp", ["_matched"], hot_rows, closed=True,
    )
    return facts.select(
        "order_id", F.col("_matched").alias("customer_sk"), "order_amount", "order_status",
        F.col("_commit_timestamp").alias("order_timestamp"),
    )


def refreshed_facts(
    facts: DataFrame, orders: DataFrame, dimension: DataFrame, touched: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Facts after late customer changes: only orders of ``touched`` customers are resolved again.

    ``touched`` holds each customer_id once.
    """
    stale = spread_lookup(
        orders.filter(F.col("customer_id").isNotNull()), touched, "customer_id", "left_semi", "order_id", hot_rows
    )
    replaced = stale.select(F.col("order_id").alias("_again"))
    untouched = facts.join(replaced, F.col("order_id").eqNullSafe(F.col("_again")), "left_anti")
    return untouched.unionByName(order_facts(stale, dimension, hot_rows))


def facts_after_batch(
    facts: DataFrame, orders: DataFrame, dimension: DataFrame, changed_orders: DataFrame, changed_versions: DataFrame,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Facts after a batch, from those before it; equal to ``order_facts`` over everything.

    ``changed_orders`` holds each order_id of the batch once, ``changed_versions`` each
    customer_id whose history changed once, with the instant ``since`` from which on it did.  Those
    orders, and orders of such customers created since then, are resolved again or, if they
    are gone, dropped; no other order meets the dimension, and no other customer's versions are read.
    """
    known = orders.filter(F.col("customer_id").isNotNull())
    moved = spread_lookup(known, changed_versions, "customer_id", "inner", "order_id", hot_rows).filter("created_at >= since")
    # both are read several times below; each comes from all orders
    again = kept(changed_orders.select("order_id").unionByName(moved.select("order_id")).distinct(), "orders-again")
    resolved = kept(orders.join(again, "order_id", "left_semi"), "orders-resolved")
    versions = dimension.join(resolved.select("customer_id").distinct(), "customer_id", "left_semi")
    untouched = facts.join(again, "order_id", "left_anti")
    return untouched.unionByName(order_facts(resolved, versions, hot_rows))


def date_dimension(first: Column, last: Column, rows: DataFrame) -> DataFrame:
    """One row per calendar day from ``first`` to ``last``, both taken from the one row of ``rows``."""
    days = rows.select(F.explode(F.sequence(first, last)).alias("calendar_date"))
    return days.select(
        C.date_key("calendar_date").alias("date_key"),
        "calendar_date",
        F.dayofmonth("calendar_date").alias("day"),
        F.month("calendar_date").alias("month"),
        F.year("calendar_date").alias("year"),
        F.quarter("calendar_date").alias("quarter"),
    )


def date_dimension_for(facts: DataFrame, at: str = "created_at") -> DataFrame:
    """The whole calendar years the facts fall in."""
    span = facts.agg(F.year(F.min(at)).alias("a"), F.year(F.max(at)).alias("z"))
    return date_dimension(
        F.make_date(F.col("a"), F.lit(1), F.lit(1)), F.make_date(F.col("z"), F.lit(12), F.lit(31)), span
    )
