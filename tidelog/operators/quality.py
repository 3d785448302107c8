"""Row-quality rules: which rows are clean, which are set aside, and why."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import schemas as S
from tidelog.functions import columns as C

_MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _bad_email() -> Column:
    return ~F.col("email").contains("@") | ~F.col("email").contains(".")


def _amount() -> Column:
    """The amount as a number; text that is none gives NULL and not an error."""
    return F.col("order_amount").try_cast("double")


# Ordered rules per entity (their names are fixed values): the first one that holds names the reason.  A rule on a
# NULL value is unknown and so does not hold.
RULES: dict[str, list[tuple[str, Callable[[], Column]]]] = {
    "customers": [
        ("NULL_PK", lambda: F.col("customer_id").isNull()),
        ("INVALID_EMAIL", _bad_email),
        ("INVALID_STATE_CODE", lambda: F.length("state") != 2),
    ],
    "orders": [
        ("NULL_PK", lambda: F.col("order_id").isNull()),
        ("NEGATIVE_AMOUNT", lambda: _amount() < 0),
    ],
}


def flagged(rows: DataFrame, entity: str) -> DataFrame:
    """Add ``_dq_failed`` and ``_quarantine_reason``."""
    reason = F.coalesce(*[F.when(rule(), F.lit(name)) for name, rule in RULES[entity]])
    return rows.withColumn("_quarantine_reason", reason).withColumn(
        "_dq_failed", F.col("_quarantine_reason").isNotNull()
    )


def split_by_rules(rows: DataFrame, entity: str, quarantined_at: Column) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine).  Unknown entities pass through with an empty quarantine.

    Both sides read the same flagged frame; each keeps its own predicate, so the
    scan of the clean side still gets its filters pushed down.
    """
    if entity not in RULES:
        return rows, rows.filter(F.lit(False))
    marked = flagged(rows, entity)
    clean = marked.filter(~F.col("_dq_failed")).drop("_dq_failed", "_quarantine_reason")
    bad = marked.filter("_dq_failed").withColumn("_quarantined_at", quarantined_at)
    return clean, bad


def rule_counts(rows: DataFrame, entity: str, target_table: str) -> DataFrame:
    """Clean and quarantined counts in one pass."""
    return flagged(rows, entity).agg(
        F.count_if(~F.col("_dq_failed")).alias("records_processed"),
        F.count_if("_dq_failed").alias("records_quarantined"),
    ).select(F.lit(target_table).alias("target_table"), "records_processed", "records_quarantined")


def reason_counts(rows: DataFrame, entity: str) -> DataFrame:
    return (
        flagged(rows, entity).filter("_dq_failed").groupBy("_quarantine_reason")
        .agg(F.count(F.lit(1)).alias("records"))
        .select(F.lit(entity).alias("entity_type"), "_quarantine_reason", "records")
    )


def key_problem(entity: str) -> Column:
    """Why the merge path refuses a row: a blank key, or an amount that is no number.  The texts are fixed values."""
    if entity == "customers":
        return F.when(C.cleaned("customer_id") == "", "Missing customer_id")
    given = F.col("order_amount").cast("string")
    return (
        F.when(C.cleaned("order_id") == "", "Missing order_id")
        .when(C.cleaned("customer_id") == "", "Missing customer_id")
        .when(given.isNull() | F.isnan(_amount()), "Invalid order_amount: Null order amount")
        .when(
            _amount().isNull(),
            F.concat(F.lit("Invalid order_amount: could not convert string to float: '"), given, F.lit("'")),
        )
        .when(~C.is_money(_amount()), F.concat(F.lit("Invalid order_amount: out of range: "), given))
    )


def key_quarantine(rows: DataFrame, entity: str, quarantined_at: Column) -> DataFrame:
    """Refused rows as documents with the source row nested as JSON."""
    record = F.to_json(
        F.struct(*rows.columns),
        {"ignoreNullFields": "false", "timestampNTZFormat": _MICROS},
    )
    return rows.withColumn("reason", key_problem(entity)).filter(F.col("reason").isNotNull()).select(
        F.lit(entity).alias("entity_type"), "reason", record.alias("record"), quarantined_at.alias("quarantined_at")
    )


def write_documents(documents: DataFrame, path: str, batch: str | int) -> None:
    """Refused rows of a batch as JSON lines in a folder of their own, so that a repeated batch replaces them."""
    documents.write.mode("overwrite").option("timestampNTZFormat", _MICROS).json(f"{path}/batch={batch}")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """The refused rows of all batches."""
    return spark.read.schema(S.DOCUMENT_SCHEMA).option("timestampNTZFormat", _MICROS).json(f"{path}/batch=*")


def keyed_rows(rows: DataFrame, entity: str) -> DataFrame:
    """The rows ``key_quarantine`` lets through."""
    return rows.filter(key_problem(entity).isNull())
