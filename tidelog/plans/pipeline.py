"""The whole chain from raw tables to measures, with tables written at the layer borders.

Staging is views, everything after it is a table, so each layer is computed once and
read back, also by the next job.  What staging refuses is stored as a table too.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.history import customer_history
from tidelog.operators.latest import current_orders
from tidelog.plans import checks, gold, kpi, runs, staging
from tidelog.sources import tables
from tidelog.sources.bronze import clustered

PIPELINE = "lake_refresh"


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _audited(
    spark: SparkSession, audit_path: str, layer: str, target: str, work: Callable[[], None],
    count: Callable[[], DataFrame],
) -> None:
    """Run a layer, record how it went, and let errors through.

    ``count`` gives (target_table, records_processed, records_quarantined) after success.
    """
    started = _utc_now()

    def record(counts: DataFrame, status: str, error: str) -> None:
        times = [F.lit(t).cast("timestamp_ntz") for t in (started, _utc_now())]
        runs.append_audit(runs.audit_rows(counts, PIPELINE, layer, status, error, *times), audit_path)

    nothing = spark.range(1).select(
        F.lit(target).alias("target_table"), F.lit(0).alias("records_processed"), F.lit(0).alias("records_quarantined")
    )
    try:
        work()
        counts = count()
    except Exception as problem:
        record(nothing, "FAILED", str(problem))
        raise
    record(counts, "SUCCESS", "")


def _row_count(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).agg(F.count(F.lit(1)).alias("records_processed")).select(
        F.lit(table).alias("target_table"), "records_processed", F.lit(0).alias("records_quarantined")
    )


def refresh(
    spark: SparkSession, raw_customers: DataFrame, raw_orders: DataFrame, schema: str, audit_path: str,
    runs_path: str | None = None,
) -> list[str]:
    """Build or rebuild every table of ``schema``; returns the names of its tables.

    Each layer leaves audit rows whose counts are those of the rows it split or
    wrote; with ``runs_path`` the run leaves its start and its end.
    """
    run_id = uuid.uuid4().hex

    def event(kind: str, records: int | None = None, error: str | None = None) -> None:
        if runs_path:
            runs.append_event(spark, runs_path, run_id, PIPELINE, kind, _utc_now(), records, error)

    event("START")
    try:
        _refresh(spark, raw_customers, raw_orders, schema, audit_path)
        facts = spark.table(f"{schema}.fact_orders").count()
    except Exception as problem:
        event("FAILED", error=str(problem))
        raise
    event("SUCCESS", facts)
    return tables.permanent_tables(spark, schema, [])


def _refresh(
    spark: SparkSession, raw_customers: DataFrame, raw_orders: DataFrame, schema: str, audit_path: str
) -> None:

    def name(table: str) -> str:
        return f"{schema}.{table}"

    def silver() -> None:
        tables.as_view(staging.staged_customers(raw_customers), "stg_customers")
        tables.as_view(staging.staged_orders(raw_orders), "stg_orders")
        tables.as_view(staging.quarantined_customers(raw_customers), "quarantine_customers")
        tables.as_view(staging.quarantined_orders(raw_orders), "quarantine_orders")
        history = customer_history(spark.table("stg_customers"))
        if not tables.create_if_absent(spark, history, name("silver_customers")):
            tables.insert_overwrite(history, name("silver_customers"))
        tables.create_or_replace(current_orders(spark.table("stg_orders")), name("silver_orders"))
        for quarantine in ("quarantine_customers", "quarantine_orders"):
            tables.create_or_replace(spark.table(quarantine), name(quarantine))

    def star() -> None:
        history, orders = spark.table(name("silver_customers")), spark.table(name("silver_orders"))
        dimension = gold.customer_dimension(history)
        tables.create_or_replace(dimension, name("dim_customers"))
        facts = gold.order_facts(orders, spark.table(name("dim_customers")))
        tables.create_or_replace(clustered(facts, ["customer_sk", "created_at"]), name("fact_orders"))
        tables.create_or_replace(gold.date_dimension_for(spark.table(name("fact_orders"))), name("dim_date"))

    def measures() -> None:
        facts, dimension = spark.table(name("fact_orders")), spark.table(name("dim_customers"))
        current = gold.current_customers(spark.table(name("silver_customers")))
        tables.create_or_replace(kpi.daily_sales(facts), name("agg_daily_sales"))
        tables.create_or_replace(kpi.revenue_trends(facts), name("agg_revenue_trends"))
        tables.create_or_replace(kpi.revenue_by_current_state(facts, dimension, current), name("agg_revenue_by_state"))
        tables.create_or_replace(kpi.customer_growth(current), name("agg_customer_growth"))
        views = {
            "vw_executive_summary": kpi.executive_summary(facts, dimension),
            "vw_sales_by_state": kpi.sales_by_state(facts, dimension),
            "vw_order_status_breakdown": kpi.order_status_breakdown(facts),
            "vw_unresolved_orders": kpi.unresolved_orders(facts),
        }
        for view, rows in views.items():
            tables.as_view(rows, view)

    def cleaned() -> DataFrame:
        return staging.side_counts(raw_customers, "customers", name("silver_customers")).unionByName(
            staging.side_counts(raw_orders, "orders", name("silver_orders"))
        )

    _audited(spark, audit_path, "silver", schema, silver, cleaned)
    _audited(spark, audit_path, "gold", schema, star, lambda: _row_count(spark, name("fact_orders")))
    _audited(spark, audit_path, "gold", schema, measures, lambda: _row_count(spark, name("agg_daily_sales")))


def layer_tables(spark: SparkSession, schema: str) -> dict[str, DataFrame]:
    """What the data tests read, from a refreshed schema."""
    stored = ["silver_customers", "silver_orders", "dim_customers", "fact_orders"]
    return {t: spark.table(f"{schema}.{t}") for t in stored} | {
        v: spark.table(v) for v in ("stg_customers", "stg_orders")
    }


def run_checks(spark: SparkSession, schema: str) -> DataFrame:
    return checks.summary(layer_tables(spark, schema))
