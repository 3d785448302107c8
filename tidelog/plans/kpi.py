"""Measures on the star schema.

A join to the customer dimension is always made *after* the facts are summed per
surrogate key: the key of unresolved orders may hold a large part of all facts,
and after the partial aggregation it is one row like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog import schemas as S
from tidelog.functions import columns as C


def _rounded(total: str) -> Column:
    return F.round(C.as_double(total), 2)


def per_customer_key(facts: DataFrame) -> DataFrame:
    return facts.groupBy("customer_sk").agg(C.money("order_amount").alias("_sum"), F.count("order_id").alias("_orders"))


def _with_customer(keyed: DataFrame, dimension: DataFrame) -> DataFrame:
    """Per-key sums with state and customer of the key; the unknown member is no customer."""
    known = dimension.select(
        "customer_sk", "state", F.when(F.col("customer_sk") != S.UNKNOWN_KEY, F.col("customer_id")).alias("_customer")
    )
    return keyed.join(known, "customer_sk", "left")


def executive_summary(facts: DataFrame, dimension: DataFrame) -> DataFrame:
    """Totals, the customers behind the facts, and their version keys (the unknown one included).

    Customers are counted over the per-key sums, which needs no second pass over the facts.
    """
    per_customer = _with_customer(per_customer_key(facts), dimension).groupBy("_customer").agg(
        F.sum("_sum").alias("_sum"), F.sum("_orders").alias("_orders"), F.count("customer_sk").alias("_keys")
    )
    return per_customer.agg(
        F.sum("_sum").alias("s"), F.sum("_orders").alias("n"), F.count("_customer").alias("c"), F.sum("_keys").alias("k")
    ).select(
        _rounded("s").alias("total_sales"),
        F.coalesce("n", F.lit(0)).cast("long").alias("total_orders"),
        F.col("c").alias("unique_customers"),
        F.coalesce("k", F.lit(0)).cast("long").alias("unique_customer_keys"),
    )


def sales_by_state(facts: DataFrame, dimension: DataFrame) -> DataFrame:
    keyed = per_customer_key(facts).join(dimension.select("customer_sk", "state"), "customer_sk", "left")
    return (
        keyed.groupBy(F.coalesce("state", F.lit("UNKNOWN")).alias("state_code"))
        .agg(F.sum("_sum").alias("s"), F.sum("_orders").alias("order_count"))
        .select("state_code", _rounded("s").alias("sales_amount"), "order_count")
        .orderBy(F.desc("sales_amount"), "state_code")
    )


def order_status_breakdown(facts: DataFrame) -> DataFrame:
    return (
        facts.groupBy("order_status").agg(F.count("order_id").alias("order_count"))
        .orderBy(F.desc("order_count"), "order_status")
    )


def unresolved_orders(facts: DataFrame) -> DataFrame:
    """Count and share of unresolved orders, NULL share on no facts, in one pass."""
    unresolved = F.count_if((F.col("customer_sk") == S.UNKNOWN_KEY) & F.col("order_id").isNotNull())
    return facts.agg(unresolved.alias("u"), F.count(F.lit(1)).alias("n")).select(
        F.col("u").alias("unresolved_orders_count"),
        F.round(F.try_divide(F.col("u") * F.lit(100.0), F.col("n")), 2).alias("unresolved_percentage"),
    )


def alert_level(unresolved: DataFrame) -> DataFrame:
    """Critical above ten per cent, warning above none."""
    level = (
        F.when(F.col("unresolved_percentage") > 10.0, "critical")
        .when(F.col("unresolved_orders_count") > 0, "warning")
        .otherwise("ok")
    )
    return unresolved.withColumn("alert_level", level)


def daily_sales(facts: DataFrame, at: str = "created_at") -> DataFrame:
    return (
        facts.groupBy(F.to_date(at).alias("order_date"))
        .agg(F.count("order_id").alias("total_orders"), C.money("order_amount").alias("s"))
        .select("order_date", "total_orders", C.as_double("s").alias("total_revenue"))
    )


def daily_revenue(daily: DataFrame) -> DataFrame:
    return daily.select("order_date", "total_revenue").orderBy("order_date")


def daily_volume(daily: DataFrame) -> DataFrame:
    return daily.select("order_date", "total_orders").orderBy("order_date")


def revenue_trends(facts: DataFrame, at: str = "created_at") -> DataFrame:
    """Spend per key and day, then per key with its first, last and number of active days."""
    by_day = facts.groupBy("customer_sk", F.to_date(at).alias("order_date")).agg(C.money("order_amount").alias("s"))
    return (
        by_day.groupBy("customer_sk")
        .agg(
            F.sum("s").alias("s"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            F.count(F.lit(1)).alias("active_days"),
        )
        .select("customer_sk", C.as_double("s").alias("total_spent"), "first_order_date", "last_order_date", "active_days")
    )


def per_customer(facts: DataFrame, dimension: DataFrame) -> DataFrame:
    """Sums per customer over all its versions."""
    keyed = per_customer_key(facts).join(dimension.select("customer_sk", "customer_id"), "customer_sk")
    return keyed.groupBy("customer_id").agg(F.sum("_sum").alias("_sum"), F.sum("_orders").alias("_orders"))


def revenue_by_current_state(facts: DataFrame, dimension: DataFrame, current: DataFrame) -> DataFrame:
    """Revenue per state the customer is in now; customers without a current version are UNKNOWN."""
    sums = per_customer(facts, dimension).join(current.select("customer_id", "state"), "customer_id", "left")
    return (
        sums.groupBy(F.coalesce("state", F.lit("UNKNOWN")).alias("state"))
        .agg(F.sum("_sum").alias("s"), F.sum("_orders").alias("state_orders"))
        .select("state", C.as_double("s").alias("state_revenue"), "state_orders")
        .orderBy(F.desc("state_revenue"), "state")
    )


def top_customers(
    facts: DataFrame, dimension: DataFrame, current: DataFrame, n: int = 10, by_name: bool = False
) -> DataFrame:
    """The n current customers that spent most.

    ``by_name`` groups on the masked name and state alone, so namesakes of a state
    are one row; otherwise each customer is its own.
    """
    sums = per_customer(facts, dimension).join(
        current.select("customer_id", "first_name", "last_name", "state"), "customer_id"
    )
    shown = ["first_name", "last_name", "state"] if by_name else ["customer_id", "first_name", "last_name", "state"]
    return (
        sums.groupBy(*shown)
        .agg(F.sum("_orders").alias("total_orders"), F.sum("_sum").alias("s"))
        .select(*shown, "total_orders", C.as_double("s").alias("lifetime_value"))
        .orderBy(F.desc("lifetime_value"), *shown)
        .limit(n)
    )


def customer_growth(current: DataFrame) -> DataFrame:
    return current.groupBy(F.date_format("valid_from", "yyyy-MM").alias("registration_month")).agg(
        F.count("customer_id").alias("new_customers")
    )


def cumulative_growth(growth: DataFrame) -> DataFrame:
    """Running total.  The window has no partition: its input is one row per month."""
    so_far = Window.orderBy("join_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    months = growth.withColumnRenamed("registration_month", "join_date")
    return months.withColumn("cumulative_customers", F.sum("new_customers").over(so_far)).orderBy("join_date")


def sales_by_quarter(facts: DataFrame, dates: DataFrame) -> DataFrame:
    """Facts are summed per day first, so the date dimension meets one row per day."""
    by_day = facts.groupBy("date_key").agg(C.money("order_amount").alias("_sum"), F.count("order_id").alias("_orders"))
    return (
        by_day.join(dates, "date_key").groupBy("year", "quarter")
        .agg(F.sum("_sum").alias("s"), F.sum("_orders").alias("order_count"))
        .select("year", "quarter", _rounded("s").alias("sales_amount"), "order_count")
        .orderBy("year", "quarter")
    )


#: Entries of a list in the dashboard document.
DOCUMENT_ROWS = 1_000


def _first(rows: DataFrame, by: str, then: str) -> DataFrame:
    return rows.orderBy(F.desc(by), then).limit(DOCUMENT_ROWS)


def _listed(rows: DataFrame, rank: list[Column]) -> Column:
    """A small result as one array, sorted by ``rank``."""
    ranks = [c.alias(f"_r{i}") for i, c in enumerate(rank)]
    ranked = F.sort_array(F.collect_list(F.struct(*ranks, F.struct(*rows.columns).alias("item"))))
    return rows.agg(F.transform(ranked, lambda x: x["item"])).scalar()


def dashboard_document(facts: DataFrame, dimension: DataFrame, runs: DataFrame, generated_at: Column) -> DataFrame:
    """One JSON document of all measures.

    The lists hold the DOCUMENT_ROWS first states by sales, as many statuses by orders,
    and the ten last runs, each cut before it becomes a list.  Money is written as
    decimals so that the text does not depend on number formatting.
    """
    two_places = "decimal(18,2)"
    # one aggregation of the facts feeds every section
    base = facts.groupBy("customer_sk", "order_status").agg(
        C.money("order_amount").alias("_sum"), F.count("order_id").alias("_orders"), F.count(F.lit(1)).alias("_rows")
    )
    keyed = base.groupBy("customer_sk").agg(*[F.sum(c).alias(c) for c in ("_sum", "_orders", "_rows")])
    unresolved = F.sum(F.when(F.col("customer_sk") == S.UNKNOWN_KEY, F.col("_orders")))
    joined = _with_customer(keyed, dimension)
    totals = joined.agg(
        F.struct(
            F.coalesce(F.sum("_sum"), F.lit(0)).cast(two_places).alias("total_sales"),
            F.coalesce(F.sum("_orders"), F.lit(0)).alias("total_orders"),
            F.count_distinct("_customer").alias("unique_customers"),
            F.count("customer_sk").alias("unique_customer_keys"),
        ).alias("executive_summary"),
        F.struct(
            F.coalesce(unresolved, F.lit(0)).alias("count"),
            F.coalesce(F.round(F.try_divide(unresolved * F.lit(100.0), F.sum("_rows")), 2), F.lit(0.0))
            .cast(two_places).alias("percentage"),
        ).alias("unresolved_orders"),
    )
    states = (
        joined.groupBy(F.coalesce("state", F.lit("UNKNOWN")).alias("state_code"))
        .agg(F.sum("_sum").cast(two_places).alias("sales_amount"), F.sum("_orders").alias("order_count"))
    )
    statuses = base.groupBy("order_status").agg(F.sum("_orders").alias("order_count"))
    latest = runs.orderBy(F.desc("start_time"), "run_id").limit(10).select(
        "run_id", "pipeline_name", C.instant_text("start_time").alias("start_time"), "status", "records_processed"
    )
    body = F.struct(
        "executive_summary",
        _listed(_first(states, "sales_amount", "state_code"), [-F.col("sales_amount"), F.col("state_code")]).alias("sales_by_state"),
        _listed(_first(statuses, "order_count", "order_status"), [-F.col("order_count"), F.col("order_status")]).alias("order_status_breakdown"),
        "unresolved_orders",
        F.reverse(_listed(latest, [F.col("start_time"), F.col("run_id")])).alias("pipeline_runs"),
        F.date_format(generated_at, "yyyy-MM-dd HH:mm:ss").alias("generated_at"),
    )
    return totals.select(F.to_json(body, {"ignoreNullFields": "false"}).alias("document"))
