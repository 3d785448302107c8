"""Staging rules.  Predicates are three-valued: a NULL email or amount is on neither side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog import schemas as S
from tidelog.functions import columns as C

# reasons of the quarantine tables; the first two are fixed values
CUSTOMER_REASON = "Invalid email format or missing state code"
ORDER_REASON, AMOUNT_REASON = "Negative order amount", "Order amount is no amount of money"


def _has_at() -> Column:
    return F.col("email").contains("@")


def _sides(entity: str) -> tuple[Column, Column]:
    """What holds for staged rows and for quarantined rows."""
    if entity == "customers":
        return _has_at() & F.col("state").isNotNull(), ~_has_at() | F.col("state").isNull()
    amount = F.col("order_amount")
    return (amount >= 0) & C.is_money(amount), (amount < 0) | ~C.is_money(amount)


def side_counts(raw: DataFrame, entity: str, target_table: str) -> DataFrame:
    """Rows staged and quarantined, and as a row of its own those on neither side, in one pass."""
    clean, bad = _sides(entity)
    counts = raw.agg(F.count_if(clean).alias("c"), F.count_if(bad).alias("q"), F.count(F.lit(1)).alias("n"))

    def row(target: str, processed: str, quarantined: str) -> Column:
        return F.struct(
            F.lit(target).alias("target_table"), F.expr(processed).alias("records_processed"),
            F.expr(quarantined).alias("records_quarantined"),
        )

    rows = F.array(row(target_table, "c", "q"), row(f"{target_table} (neither side)", "n - c - q", "0L"))
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def staged_customers(raw: DataFrame) -> DataFrame:
    return raw.filter(_sides("customers")[0]).select(S.landed_columns("customers"))


def staged_orders(raw: DataFrame) -> DataFrame:
    return raw.filter(_sides("orders")[0]).select(S.landed_columns("orders"))


def quarantined_customers(raw: DataFrame) -> DataFrame:
    rows = raw.filter(_sides("customers")[1])
    return rows.select(*S.landed_columns("customers"), F.lit(CUSTOMER_REASON).alias("quarantine_reason"))


def quarantined_orders(raw: DataFrame) -> DataFrame:
    rows = raw.filter(_sides("orders")[1])
    reason = F.when(C.is_money(F.col("order_amount")), ORDER_REASON).otherwise(AMOUNT_REASON)
    return rows.select(*S.landed_columns("orders"), reason.alias("quarantine_reason"))
