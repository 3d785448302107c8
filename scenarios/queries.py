"""The registered queries: every operator over the whole tables of a test-data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scenarios.feed import CUT, STAMP, TODAY, WEEKS, Lake, faulty_tables, lake_of, ntz, spread_customers, spread_facts
from tidelog import schemas as S
from tidelog import workspace
from tidelog.functions import columns as C
from tidelog.operators import capture, history, latest, merge, quality
from tidelog.plans import checks, gold, increments, kpi, pipeline, runs, staging, state
from tidelog.sources import bronze, feed, ledger
from tidelog.streaming import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def query(build: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
    """Register under the function's name.  ``valid_to`` is shown as text: its open end lies outside pandas' range."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = build(lake_of(spark, sf_dir))
        return rows.withColumn("valid_to", C.instant_text("valid_to")) if "valid_to" in rows.columns else rows

    QUERIES[build.__name__.rstrip("_")] = run
    return build


def _before_cut(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("ingest_date") < F.lit(CUT).cast("date"))


def _from_cut(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("ingest_date") >= F.lit(CUT).cast("date"))


def _delivered_late():
    """The days whose customer changes arrive after those of all other days."""
    return F.dayofmonth("ingest_date").between(11, 20)


# --- change feed and raw layer ---------------------------------------------------------


@query
def cdc_incremental_extract(lake: Lake) -> DataFrame:
    log = lake.change_log
    mark = feed.high_water_mark(log.filter(F.col("_commit_timestamp") < ntz(f"{CUT} 00:00:00")))
    return feed.changes_after(log, mark, ordered=True)


@query
def cdc_high_water_mark(lake: Lake) -> DataFrame:
    return feed.high_water_mark(lake.change_log)


@query
def cdc_entity_split(lake: Lake) -> DataFrame:
    log = lake.change_log
    return feed.entity_changes(log, "customers").unionByName(feed.entity_changes(log, "orders"), allowMissingColumns=True)


def _write_array_files(lake: Lake, path: str) -> None:
    """Feed files of one JSON array per line (at most 5000 ids each), a file that is no JSON, an unknown entity."""
    suppliers = lake.source("supplier").select(
        (-F.col("s_suppkey")).cast("long").alias("_row_sequence_id"), F.lit("suppliers").alias("entity_type"),
        F.lit("INSERT").alias("_change_type"), ntz(STAMP).alias("_commit_timestamp"),
    )
    events = lake.change_log.unionByName(suppliers, allowMissingColumns=True)
    chunk = F.floor(F.col("_row_sequence_id") / 5000).alias("chunk")
    arrays = events.groupBy(chunk).agg(F.collect_list(F.struct(*events.columns)).alias("a"))
    arrays.select(F.to_json("a", {"timestampNTZFormat": _MICROS}).alias("value")).write.text(path)
    lake.spark.range(1).select(F.lit('[{"_row_sequence_id": 1, "entity_type": ').alias("value")).write.mode("append").text(path)


@query
def bronze_json_ingest(lake: Lake) -> DataFrame:
    files, raw = workspace.new_dir(lake.spark, "feed"), workspace.new_dir(lake.spark, "raw")
    _write_array_files(lake, files)
    events = feed.read_change_files(lake.spark, files)
    stamped = bronze.stamped(events, ntz(STAMP), F.lit("batch-one"))
    written = bronze.write_entities(stamped, lambda entity: f"{raw}/{entity}")
    landed = [lake.spark.read.schema(S.struct_of([*columns, "ingest_date"])).parquet(f"{raw}/{e}") for e, columns in written.items()]
    return landed[0].unionByName(landed[1], allowMissingColumns=True).drop(S.EXTRA)


def _write_misfits(lake: Lake, path: str) -> None:
    """The feed as array lines of 500 source events, with planted misfits.

    Every 23rd source event has text for an amount, others 1e19 or NaN, every 13th an
    undeclared phone number; some say no entity or no kind of change, some are of an
    unknown entity; each array ends in an element that is no event, and one line is cut off.
    """
    no = F.floor(F.col("_row_sequence_id") / 10)
    log = lake.change_log.withColumns({"_no": no, "_amount": F.col("order_amount").cast("string")})
    orders, customers = F.col("entity_type") == "orders", F.col("entity_type") == "customers"
    rows = log.withColumns(
        {
            "order_amount": F.when(orders & (no % 23 == 0), F.concat(F.lit("about "), "_no")).when(orders & (no % 37 == 0), "1e19")
            .when(orders & (no % 41 == 0), "NaN").otherwise(F.col("_amount")),
            "entity_type": F.when(no % 31 == 0, None).when(no % 47 == 0, "suppliers").otherwise(F.col("entity_type")),
            "_change_type": F.when(no % 43 != 0, F.col("_change_type")),
            "phone": F.when(customers & (F.col("_no") % 13 == 0), F.concat(F.lit("555-"), "_no")),
        }
    )
    fields = F.struct(*[c for c in rows.columns if c not in ("_no", "_amount")])
    texts = rows.select(
        F.floor(F.col("_no") / 500).alias("chunk"), F.to_json(fields, {"timestampNTZFormat": _MICROS}).alias("j")
    )
    arrays = texts.groupBy("chunk").agg(F.concat_ws(",", F.collect_list("j")).alias("j"))
    arrays.select(F.concat(F.lit("["), "j", F.lit(", 17]")).alias("value")).write.text(path)
    lake.spark.range(1).select(F.lit('[{"_row_sequence_id": 1, "entity_type": ').alias("value")).write.mode("append").text(path)


def _judged_misfits(lake: Lake) -> DataFrame:
    """All elements of the feed with misfits, parsed and judged once."""
    files = lake.folder("misfit_feed", lambda path: _write_misfits(lake, path))
    return lake.stored("misfits_judged", lambda: feed.read_as(feed.read_elements(lake.spark, files)))


@query
def bronze_misfit_ingest(lake: Lake) -> DataFrame:
    """Every element of a feed with misfits: landed as a raw row, refused with its reason, or counted for an unknown entity."""
    judged, base = _judged_misfits(lake), workspace.new_dir(lake.spark, "misfits")
    stamped = bronze.stamped(feed.events_in(judged), ntz(STAMP), F.lit("one"))
    bronze.write_entities(stamped, lambda e: f"{base}/{e}")
    quality.write_documents(feed.refused_in(judged, ntz(STAMP)), f"{base}/refused", "one")
    parts = [
        bronze.read_raw(lake.spark, f"{base}/{e}", e, [S.EXTRA]).select(
            F.lit("landed").alias("side"), "entity_type", "_row_sequence_id",
            (F.col("order_amount") if e == "orders" else F.lit(None).cast("double")).alias("order_amount"),
            F.col(S.EXTRA)["phone"].alias("phone"), F.lit(None).cast("string").alias("reason"), F.lit(1).cast("long").alias("n"),
        )
        for e in S.ENTITY_COLUMNS
    ]
    refused = quality.read_documents(lake.spark, f"{base}/refused").select(
        F.lit("refused").alias("side"), "entity_type",
        F.get_json_object("record", "$._row_sequence_id").try_cast("long").alias("_row_sequence_id"), "reason", F.lit(1).cast("long").alias("n"),
    )
    unknown = bronze.unknown_entities(stamped).select(F.lit("unknown").alias("side"), "entity_type", F.col("row_count").alias("n"))
    sides = parts[0].unionByName(parts[1])
    for more in (refused, unknown):
        sides = sides.unionByName(more, allowMissingColumns=True)
    return sides


@query
def schema_drift_unknown(lake: Lake) -> DataFrame:
    return bronze.drift_report(feed.events_in(_judged_misfits(lake)))


@query
def bronze_full_scan(lake: Lake) -> DataFrame:
    path = workspace.new_dir(lake.spark, "refresh")
    tables = {"customers": lake.raw_customers, "orders": lake.raw_orders}
    for entity, rows in tables.items():
        bronze.replace_table(rows, f"{path}/{entity}")
    customers, orders = (lake.spark.read.schema(rows.schema).parquet(f"{path}/{entity}") for entity, rows in tables.items())
    return customers.unionByName(orders, allowMissingColumns=True)


@query
def bronze_pending_batches(lake: Lake) -> DataFrame:
    processed = bronze.batch_ids(_before_cut(lake.raw_customers), _before_cut(lake.raw_orders))
    return bronze.pending_batches(bronze.batch_ids(lake.raw_customers, lake.raw_orders), processed)


@query
def bronze_conform(lake: Lake) -> DataFrame:
    customers, orders = bronze.conformed(lake.raw_customers, "customers"), bronze.conformed(lake.raw_orders, "orders")
    return customers.unionByName(orders, allowMissingColumns=True)


@query
def schema_drift_report(lake: Lake) -> DataFrame:
    return bronze.drift_report(lake.change_log)


# --- landed batches and what is applied of them ---------------------------------------------


@query
def ledger_full_scan(lake: Lake) -> DataFrame:
    """Both entities over all batches; the columns come from the ledger, not from footers."""
    raw, lists = lake.landed()
    customers, orders = (ledger.read_raw(lake.spark, raw, lists, e) for e in ("customers", "orders"))
    return customers.unionByName(orders, allowMissingColumns=True)


@query
def ledger_schema_log(lake: Lake) -> DataFrame:
    return ledger.schema_log(lake.spark, lake.landed()[1])


@query
def ledger_changes_after(lake: Lake) -> DataFrame:
    """The increment above the mark at the cut, from the folders that hold any of it."""
    raw, lists = lake.landed()
    mark = feed.high_water_mark(lake.change_log.filter(F.col("_commit_timestamp") < ntz(f"{CUT} 00:00:00"))).first()
    parts = [ledger.changes_after(lake.spark, raw, lists, e, mark.last_processed_id) for e in ("customers", "orders")]
    return parts[0].unionByName(parts[1], allowMissingColumns=True).drop(ledger.BATCH, "ingest_date", "_bronze_ingested_at")


@query
def ledger_pending(lake: Lake) -> DataFrame:
    """What is left after a run that was allowed two batches."""
    raw, lists = lake.landed()
    job = f"part-{uuid.uuid4().hex[:12]}"
    increments.apply_pending(lake.spark, raw, lists, workspace.new_dir(lake.spark, "state"), job, limit=2)
    return ledger.pending(lake.spark, lists, job).drop("landed_at")


def _applied_batches(lake: Lake) -> str:
    """The state after two runs of the job over all batches."""

    def run(path: str) -> None:
        raw, lists = lake.landed()
        for limit in (3, None):
            increments.apply_pending(lake.spark, raw, lists, path, "whole", limit)

    return lake.folder("applied_batches", run)


@query
def ledger_history(lake: Lake) -> DataFrame:
    return state.read_history(lake.spark, _applied_batches(lake), WEEKS - 1)


@query
def ledger_orders(lake: Lake) -> DataFrame:
    return state.read_orders(lake.spark, _applied_batches(lake), WEEKS - 1)


@query
def ledger_facts(lake: Lake) -> DataFrame:
    """Facts kept up batch by batch: only what a batch can have changed meets the dimension again."""
    spark, root = lake.spark, _applied_batches(lake)
    facts = None
    for version in range(WEEKS):
        orders = lake.stored(f"orders-after-{version}", lambda v=version: state.read_orders(spark, root, v))
        dimension = gold.customer_dimension(state.read_history(spark, root, version))
        if facts is None:
            found = gold.order_facts(orders, dimension)
        else:
            changed = state.changed_orders(spark, root, version), state.changed_versions(spark, root, version)
            found = gold.facts_after_batch(facts, orders, dimension, *changed)
        facts = lake.stored(f"facts-after-{version}", lambda found=found: found)
    return facts


# --- staging and quality ----------------------------------------------------------------


@query
def stg_customers(lake: Lake) -> DataFrame:
    return lake.stg_customers


@query
def stg_orders(lake: Lake) -> DataFrame:
    return lake.stg_orders


@query
def quarantine_customers(lake: Lake) -> DataFrame:
    return staging.quarantined_customers(lake.raw_customers)


@query
def quarantine_orders(lake: Lake) -> DataFrame:
    return staging.quarantined_orders(lake.raw_orders)


def _split(lake: Lake, entity: str) -> tuple[DataFrame, DataFrame]:
    raw = lake.raw_customers if entity == "customers" else lake.raw_orders
    return quality.split_by_rules(raw, entity, ntz(STAMP))


@query
def dq_customers(lake: Lake) -> DataFrame:
    return _split(lake, "customers")[1]


@query
def dq_customers_clean(lake: Lake) -> DataFrame:
    return _split(lake, "customers")[0]


@query
def dq_orders(lake: Lake) -> DataFrame:
    return _split(lake, "orders")[1]


@query
def dq_orders_clean(lake: Lake) -> DataFrame:
    return _split(lake, "orders")[0]


@query
def dq_passthrough(lake: Lake) -> DataFrame:
    clean, bad = quality.split_by_rules(lake.source("events"), "events", ntz(STAMP))
    return clean.withColumn("side", F.lit("clean")).unionByName(bad.withColumn("side", F.lit("quarantine")))


@query
def dq_quarantine_append(lake: Lake) -> DataFrame:
    """Rejected rows of both entities, appended in two parts of which the first lacks a column."""
    path, parts = workspace.new_dir(lake.spark, "quarantine"), []
    for entity in S.ENTITY_COLUMNS:
        bad = _split(lake, entity)[1]
        _before_cut(bad).drop("loyalty_tier").write.mode("append").parquet(f"{path}/{entity}")
        _from_cut(bad).write.mode("append").parquet(f"{path}/{entity}")
        parts.append(lake.spark.read.schema(bad.schema).parquet(f"{path}/{entity}"))
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


@query
def dq_run_counts(lake: Lake) -> DataFrame:
    return quality.rule_counts(lake.raw_customers, "customers", "silver_customers").unionByName(
        quality.rule_counts(lake.raw_orders, "orders", "silver_orders")
    )


@query
def quarantine_reason_counts(lake: Lake) -> DataFrame:
    return quality.reason_counts(lake.raw_customers, "customers").unionByName(
        quality.reason_counts(lake.raw_orders, "orders")
    )


@query
def silver_key_quarantine(lake: Lake) -> DataFrame:
    return quality.key_quarantine(lake.raw_customers, "customers", ntz(STAMP)).unionByName(
        quality.key_quarantine(lake.raw_orders, "orders", ntz(STAMP))
    )


# --- history and latest state ------------------------------------------------------------


@query
def silver_customers(lake: Lake) -> DataFrame:
    return history.customer_history(lake.stg_customers)


@query
def silver_customers_ts_key(lake: Lake) -> DataFrame:
    return history.customer_history_by_instant(lake.raw_customers)


@query
def silver_orders(lake: Lake) -> DataFrame:
    return latest.current_orders(lake.stg_orders)


def _history_at_cut(lake: Lake) -> DataFrame:
    first = _before_cut(lake.raw_customers)
    return lake.stored("history_at_cut", lambda: merge.merge_history(merge.empty_history(first), first))


def _orders_at_cut(lake: Lake) -> DataFrame:
    def build() -> DataFrame:
        first = quality.keyed_rows(_before_cut(lake.raw_orders), "orders")
        return merge.upsert_changes(lake.silver_orders.limit(0), first, "order_id")

    return lake.stored("orders_at_cut", build)


@query
def scd2_merge_batch(lake: Lake) -> DataFrame:
    return merge.merge_history(_history_at_cut(lake), _from_cut(lake.raw_customers))


@query
def scd2_late_events(lake: Lake) -> DataFrame:
    raw = lake.raw_customers
    punctual, late = raw.filter(~_delivered_late()), raw.filter(_delivered_late())
    known = lake.stored(
        "history_without_late_days", lambda: merge.merge_history(merge.empty_history(punctual), punctual)
    )
    return merge.late_changes(known, late)


def _staged_target(lake: Lake) -> DataFrame:
    return lake.stored("staged_target", lambda: merge.first_load(_before_cut(_split(lake, "customers")[0])))


def _staged_source(lake: Lake) -> DataFrame:
    return merge.net_changes(_from_cut(_split(lake, "customers")[0]))


@query
def scd2_staged_updates(lake: Lake) -> DataFrame:
    changes = _staged_source(lake).select(S.CHANGE_COLUMNS + S.CUSTOMER_COLUMNS)
    return merge.staged_changes(_staged_target(lake), changes)


@query
def scd2_staged_merge(lake: Lake) -> DataFrame:
    return merge.staged_merge(_staged_target(lake), _staged_source(lake))


@query
def orders_upsert_batch(lake: Lake) -> DataFrame:
    batch = quality.keyed_rows(_from_cut(lake.raw_orders), "orders")
    return merge.upsert_changes(_orders_at_cut(lake), batch, "order_id")


@query
def orders_merge_all(lake: Lake) -> DataFrame:
    clean = _split(lake, "orders")[0].select(S.landed_columns("orders"))
    target = lake.stored(
        "merged_orders_at_cut",
        lambda: merge.upsert_changes(clean.limit(0), clean.filter(F.col("_commit_timestamp") < ntz(CUT)), "order_id", False),
    )
    return merge.upsert_changes(target, clean.filter(F.col("_commit_timestamp") >= ntz(CUT)), "order_id", False)


def _order_snapshot(lake: Lake, until: str) -> DataFrame:
    """Orders as they stood at an instant."""
    seen = lake.raw_orders.filter(F.col("order_id").isNotNull() & (F.col("_commit_timestamp") < ntz(until)))
    last = latest.latest_per_key(seen, "order_id", ["_commit_timestamp", "_row_sequence_id"])
    return last.filter(F.col("_change_type") != S.DELETE).select(S.ORDER_COLUMNS)


def _customer_snapshot(lake: Lake, until: str) -> DataFrame:
    """Customers as they stood at an instant."""
    seen = lake.raw_customers.filter(F.col("customer_id").isNotNull() & (F.col("_commit_timestamp") < ntz(until)))
    last = latest.latest_per_key(seen, "customer_id", ["_commit_timestamp", "_row_sequence_id"])
    return last.filter(F.col("_change_type") != S.DELETE).select(S.CUSTOMER_COLUMNS)


@query
def cdc_snapshot_diff(lake: Lake) -> DataFrame:
    orders = capture.snapshot_changes(_order_snapshot(lake, CUT), _order_snapshot(lake, TODAY), "order_id")
    customers = capture.snapshot_changes(_customer_snapshot(lake, CUT), _customer_snapshot(lake, TODAY), "customer_id")
    return orders.withColumn("entity_type", F.lit("orders")).unionByName(
        customers.withColumn("entity_type", F.lit("customers")), allowMissingColumns=True
    )


@query
def snapshot_diff_by_digest(lake: Lake) -> DataFrame:
    """Two stored snapshots a day apart: buckets of equal digests are not compared row by row."""
    until = "2024-01-16"
    old, new = (lake.stored(f"orders-at-{at}", lambda at=at: _order_snapshot(lake, at)) for at in (CUT, until))
    return capture.snapshot_changes_by_digest(old, new, "order_id").withColumn("entity_type", F.lit("orders"))


@query
def cdc_cascade_set_null(lake: Lake) -> DataFrame:
    deletes = lake.raw_customers.filter(
        (F.col("_change_type") == S.DELETE) & F.col("customer_id").isNotNull()
        & (F.col("_commit_timestamp") >= ntz(CUT))
    )
    first_delete = deletes.groupBy("customer_id").agg(F.min("_commit_timestamp").alias("_commit_timestamp"))
    return capture.cascade_set_null(_order_snapshot(lake, CUT), first_delete, "customer_id", "order_id")


# --- star schema ------------------------------------------------------------------------


@query
def dim_customers(lake: Lake) -> DataFrame:
    return gold.customer_dimension(lake.silver_customers)


@query
def dim_customers_current(lake: Lake) -> DataFrame:
    return lake.current_customers


@query
def dim_date(lake: Lake) -> DataFrame:
    return gold.date_dimension_for(lake.silver_orders)


@query
def fact_orders(lake: Lake) -> DataFrame:
    return gold.order_facts(lake.silver_orders, lake.dim_customers)


@query
def fact_orders_commit_time(lake: Lake) -> DataFrame:
    known = lake.stored("staged_history", lambda: merge.first_load(_split(lake, "customers")[0]))
    orders = latest.latest_per_key(_split(lake, "orders")[0], "order_id", ["_commit_timestamp", "_row_sequence_id"])
    return gold.order_facts_by_commit(orders, known)


@query
def gold_incremental_upsert(lake: Lake) -> DataFrame:
    def facts(orders: DataFrame, known: DataFrame) -> DataFrame:
        return gold.order_facts(orders, gold.customer_dimension(known))

    target = lake.stored("facts_at_cut", lambda: facts(_orders_at_cut(lake), _history_at_cut(lake)))
    known = lake.stored("history_merged", lambda: scd2_merge_batch(lake))
    orders = lake.stored("orders_upserted", lambda: orders_upsert_batch(lake))
    incoming = lake.stored("facts_after_cut", lambda: facts(orders, known))
    return merge.upsert(target, incoming, "order_id")


@query
def late_dimension_resolution(lake: Lake) -> DataFrame:
    staged = lake.stg_customers.withColumn("ingest_date", F.to_date("_commit_timestamp"))
    known = gold.customer_dimension(history.customer_history(staged.filter(~_delivered_late())))
    loaded = lake.stored("facts_before_late_days", lambda: gold.order_facts(lake.silver_orders, known))
    touched = staged.filter(_delivered_late() & F.col("customer_id").isNotNull()).select("customer_id").distinct()
    return gold.refreshed_facts(loaded, lake.silver_orders, lake.dim_customers, touched)


@query
def interleaved_fact_write(lake: Lake) -> DataFrame:
    path = workspace.new_dir(lake.spark, "interleaved")
    bronze.interleaved(lake.fact_orders, ["customer_sk", "created_at"], 16).write.parquet(path)
    return lake.spark.read.parquet(path)


@query
def clustered_fact_write(lake: Lake) -> DataFrame:
    path = workspace.new_dir(lake.spark, "clustered")
    bronze.clustered(lake.fact_orders, ["customer_sk", "created_at"]).write.parquet(path)
    return lake.spark.read.parquet(path)


# --- measures ---------------------------------------------------------------------------


@query
def executive_summary(lake: Lake) -> DataFrame:
    return kpi.executive_summary(lake.fact_orders, lake.dim_customers)


@query
def sales_by_state(lake: Lake) -> DataFrame:
    return kpi.sales_by_state(lake.fact_orders, lake.dim_customers)


@query
def order_status_breakdown(lake: Lake) -> DataFrame:
    return kpi.order_status_breakdown(lake.fact_orders)


@query
def unresolved_orders(lake: Lake) -> DataFrame:
    return kpi.unresolved_orders(lake.fact_orders)


@query
def unresolved_alert_level(lake: Lake) -> DataFrame:
    return kpi.alert_level(kpi.unresolved_orders(lake.fact_orders))


@query
def agg_daily_sales(lake: Lake) -> DataFrame:
    return kpi.daily_sales(lake.fact_orders)


@query
def daily_revenue_trend(lake: Lake) -> DataFrame:
    return kpi.daily_revenue(kpi.daily_sales(lake.fact_orders))


@query
def daily_orders_volume(lake: Lake) -> DataFrame:
    return kpi.daily_volume(kpi.daily_sales(lake.fact_orders))


@query
def agg_revenue_trends(lake: Lake) -> DataFrame:
    return kpi.revenue_trends(lake.fact_orders)


@query
def agg_revenue_by_state(lake: Lake) -> DataFrame:
    return kpi.revenue_by_current_state(lake.fact_orders, lake.dim_customers, lake.current_customers)


@query
def agg_customer_growth(lake: Lake) -> DataFrame:
    return kpi.customer_growth(lake.current_customers)


@query
def customer_growth_cumulative(lake: Lake) -> DataFrame:
    return kpi.cumulative_growth(kpi.customer_growth(lake.current_customers))


@query
def top_customers_ltv(lake: Lake) -> DataFrame:
    return kpi.top_customers(lake.fact_orders, lake.dim_customers, lake.current_customers)


@query
def sales_by_quarter(lake: Lake) -> DataFrame:
    return kpi.sales_by_quarter(lake.fact_orders, gold.date_dimension_for(lake.fact_orders))


@query
def dashboard_document(lake: Lake) -> DataFrame:
    return kpi.dashboard_document(lake.fact_orders, lake.dim_customers, runs.run_status(lake.run_events), ntz(STAMP))


@query
def spread_daily_sales(lake: Lake) -> DataFrame:
    """Days of more than a year; amounts have thousandths and only sums are rounded."""
    return kpi.daily_sales(spread_facts(lake))


@query
def spread_revenue_trends(lake: Lake) -> DataFrame:
    return kpi.revenue_trends(spread_facts(lake))


@query
def spread_sales_by_quarter(lake: Lake) -> DataFrame:
    facts = spread_facts(lake)
    return kpi.sales_by_quarter(facts, gold.date_dimension_for(facts))


@query
def spread_growth(lake: Lake) -> DataFrame:
    return kpi.cumulative_growth(kpi.customer_growth(spread_customers(lake)))


# --- data tests -------------------------------------------------------------------------


@query
def test_not_null(lake: Lake) -> DataFrame:
    return checks.not_null(lake.test_tables)


@query
def test_unique(lake: Lake) -> DataFrame:
    return checks.unique(lake.test_tables)


@query
def test_relationships_customer_sk(lake: Lake) -> DataFrame:
    return checks.relationship(lake.fact_orders, lake.dim_customers)


@query
def test_accepted_status(lake: Lake) -> DataFrame:
    return checks.accepted_status(lake.fact_orders)


@query
def test_non_negative_amount(lake: Lake) -> DataFrame:
    return checks.negative_amounts(lake.silver_orders)


@query
def check_orphan_facts(lake: Lake) -> DataFrame:
    return checks.orphaned_facts(lake.fact_orders, lake.dim_customers)


@query
def multi_version_customers(lake: Lake) -> DataFrame:
    return checks.multi_version_customers(lake.dim_customers)


@query
def multi_version_orders(lake: Lake) -> DataFrame:
    return checks.multi_version_orders(lake.fact_orders, lake.dim_customers)


@query
def dq_test_summary(lake: Lake) -> DataFrame:
    return checks.summary(lake.test_tables)


@query
def dq_test_findings(lake: Lake) -> DataFrame:
    """Every data test over tables with planted faults."""
    return checks.summary(faulty_tables(lake))


@query
def orphan_findings(lake: Lake) -> DataFrame:
    """Facts of lost parents; with a key missing in the dimension NOT IN would find none."""
    tables = faulty_tables(lake)
    return checks.orphaned_facts(tables["fact_orders"], tables["dim_customers"].filter("customer_sk is not null"))


@query
def negative_amount_findings(lake: Lake) -> DataFrame:
    return checks.negative_amounts(faulty_tables(lake)["silver_orders"])


# --- runs and audit ---------------------------------------------------------------------


@query
def audit_append(lake: Lake) -> DataFrame:
    path = workspace.new_dir(lake.spark, "audit")
    started, ended = ntz(STAMP), ntz("2024-02-01 00:01:30.250")
    for status, error in (("SUCCESS", ""), ("FAILED", "boom")):
        rows = runs.audit_rows(dq_run_counts(lake), "silver_processing", "silver", status, error, started, ended)
        runs.append_audit(rows, path)
    return lake.spark.read.schema(S.AUDIT_SCHEMA).parquet(path).drop("log_id")


@query
def pipeline_run_status(lake: Lake) -> DataFrame:
    return runs.run_status(lake.run_events)


@query
def recent_pipeline_runs(lake: Lake) -> DataFrame:
    return runs.recent_runs(runs.run_status(lake.run_events))


@query
def failed_runs(lake: Lake) -> DataFrame:
    return runs.alerts(runs.failed(runs.run_status(lake.run_events), "run_id"))


@query
def duration_trend(lake: Lake) -> DataFrame:
    return runs.duration_trend(lake.audit_log)


@query
def dq_status_last_7_days(lake: Lake) -> DataFrame:
    return runs.quality_by_status(lake.audit_log, F.lit(TODAY).cast("date"))


@query
def dq_status_hourly(lake: Lake) -> DataFrame:
    """Runs of an hour: many quarantine nothing."""
    return runs.quality_by_status(lake.audit_by("hour"), F.lit(TODAY).cast("date"))


# --- streams and the whole chain ----------------------------------------------------------


@query
def stream_bronze_ingest(lake: Lake) -> DataFrame:
    spark, base = lake.spark, workspace.new_dir(lake.spark, "stream")
    log = lake.change_log
    topic, raw = f"{base}/topic", f"{base}/raw"
    for part in (log.filter(F.col("_commit_timestamp") < ntz(CUT)), log.filter(F.col("_commit_timestamp") >= ntz(CUT))):
        feed.append_topic(part, topic)
        jobs.ingest_available(spark, topic, raw, f"{base}/checkpoint", ntz(STAMP), archive=f"{base}/archive")
    # nothing new has arrived: this run adds no rows
    jobs.ingest_available(spark, topic, raw, f"{base}/checkpoint", ntz(STAMP), archive=f"{base}/archive")
    landed = [jobs.read_landed(spark, raw, e, ["loyalty_tier"] if e == "customers" else None) for e in S.ENTITY_COLUMNS]
    return landed[0].unionByName(landed[1], allowMissingColumns=True)


def _apply_in_two_batches(lake: Lake, base: str) -> None:
    spark, log = lake.spark, lake.change_log
    for part in (log.filter(F.col("_commit_timestamp") < ntz(CUT)), log.filter(F.col("_commit_timestamp") >= ntz(CUT))):
        feed.append_topic(part, f"{base}/topic")
        jobs.apply_available(spark, f"{base}/topic", f"{base}/state", f"{base}/checkpoint")


def _applied(lake: Lake) -> str:
    """The state left by one run of the stream, for the queries that read what it kept."""
    return lake.folder("applied", lambda path: _apply_in_two_batches(lake, path)) + "/state"


@query
def stream_scd2_apply(lake: Lake) -> DataFrame:
    base = workspace.new_dir(lake.spark, "apply")
    _apply_in_two_batches(lake, base)
    return state.read_history(lake.spark, f"{base}/state", 1).drop("_bronze_batch_id")


@query
def stream_orders_apply(lake: Lake) -> DataFrame:
    return state.read_orders(lake.spark, _applied(lake), 1).drop("_bronze_batch_id")


@query
def stream_quarantine(lake: Lake) -> DataFrame:
    rows = quality.read_documents(lake.spark, f"{_applied(lake)}/quarantine")
    return rows.select("entity_type", "reason", F.get_json_object("record", "$._row_sequence_id").cast("long").alias("_row_sequence_id"))


@query
def stream_late_events(lake: Lake) -> DataFrame:
    return state.read_late(lake.spark, _applied(lake), 1).drop("_bronze_batch_id")


def _refreshed(lake: Lake) -> tuple[str, str, list[str]]:
    """A new schema with every table of the chain: its name, its audit folder, its tables."""
    spark = lake.spark
    schema = f"tidelog_{uuid.uuid4().hex[:12]}"
    base = workspace.new_dir(spark, "warehouse")
    spark.sql(f"create database {schema} location '{base}/{schema}'")
    names = pipeline.refresh(spark, lake.raw_customers, lake.raw_orders, schema, f"{base}/audit", f"{base}/runs")
    return schema, f"{base}/audit", names


def _refreshed_twice(lake: Lake) -> str:
    """A schema built from the rows before the cut, and refreshed with all rows."""
    spark, schema = lake.spark, f"tidelog_twice_{uuid.uuid4().hex[:12]}"

    def run(base: str) -> None:
        spark.sql(f"create database {schema} location '{base}/db'")
        for customers, orders in ((_before_cut(lake.raw_customers), _before_cut(lake.raw_orders)), (lake.raw_customers, lake.raw_orders)):
            pipeline.refresh(spark, customers, orders, schema, f"{base}/audit")
        lake.names["refreshed twice"] = schema
        # by name, before another refresh gives the name to a view of its own
        lake.views["vw_sales_by_state"] = spark.sql("select * from vw_sales_by_state")

    lake.folder("refreshed_twice", run)
    return lake.names["refreshed twice"]


@query
def refreshed_history(lake: Lake) -> DataFrame:
    """The history table after its rows were overwritten."""
    return lake.spark.table(f"{_refreshed_twice(lake)}.silver_customers")


@query
def refreshed_facts_table(lake: Lake) -> DataFrame:
    """The fact table after it was replaced."""
    return lake.spark.table(f"{_refreshed_twice(lake)}.fact_orders")


@query
def refreshed_quarantine(lake: Lake) -> DataFrame:
    return lake.spark.table(f"{_refreshed_twice(lake)}.quarantine_customers")


@query
def refreshed_state_view(lake: Lake) -> DataFrame:
    """A measure view that the refresh left; it reads the replaced tables."""
    _refreshed_twice(lake)
    return lake.views["vw_sales_by_state"]


@query
def pipeline_audit(lake: Lake) -> DataFrame:
    schema, audit, _ = _refreshed(lake)
    rows = lake.spark.read.schema(S.AUDIT_SCHEMA).parquet(audit)
    return rows.select(
        "layer", F.replace("target_table", F.lit(f"{schema}."), F.lit("")).alias("target_table"), "status",
        "records_processed", "records_quarantined",
    )


@query
def full_pipeline(lake: Lake) -> DataFrame:
    spark = lake.spark
    schema, _, names = _refreshed(lake)
    counts = [
        spark.table(f"{schema}.{n}").agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
        for n in names
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out
