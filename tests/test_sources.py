from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from scenarios.feed import ntz
from tidelog import schemas as S
from tidelog import workspace
from tidelog.operators import quality
from tidelog.plans import pipeline, runs, state
from tidelog.sources import bronze, feed, tables
from tidelog.streaming import jobs

AT = "2024-01-02 03:04:05.678901"


def record(seq, entity="customers", **more):
    return {"_row_sequence_id": seq, "entity_type": entity, "_change_type": "INSERT", "_commit_timestamp": AT.replace(" ", "T"), **more}


def test_array_files_and_unreadable_files(spark, tmp_path):
    (tmp_path / "cdc_batch_1.json").write_text(json.dumps([record(1, customer_id="c"), record(2, "orders", order_id="o")], indent=4))
    (tmp_path / "cdc_batch_2.json").write_text(json.dumps([record(3)], indent=4))
    (tmp_path / "cdc_batch_3.json").write_text('[{"_row_sequence_id": 4, "entity_type": ')
    rows = feed.read_change_files(spark, str(tmp_path / "cdc_batch_*.json"), whole_file_arrays=True)
    assert sorted(r._row_sequence_id for r in rows.collect()) == [1, 2, 3]
    assert rows.filter("_row_sequence_id = 1").first()._commit_timestamp == dt.datetime.fromisoformat(AT)


def test_line_files(spark, tmp_path):
    lines = [json.dumps(record(1)), json.dumps([record(2), record(3)]), "{broken", ""]
    (tmp_path / "a.json").write_text("\n".join(lines))
    rows = feed.read_change_files(spark, str(tmp_path))
    assert sorted(r._row_sequence_id for r in rows.collect()) == [1, 2, 3]


def test_one_bad_value_costs_one_event(spark, tmp_path):
    line = [record(1, "orders", order_amount="x"), record(2, "orders", order_amount="7.5"), record(3, phone="5", tags=["a"]), 9, None]
    lines = [json.dumps(line), '{"_row_sequence_id": 4,', json.dumps(record(5)) + " tail", json.dumps(record("six")), "  ", "[]"]
    (tmp_path / "a.json").write_text("\n".join(lines))
    told = feed.read_elements(spark, str(tmp_path))
    events = {r._row_sequence_id: r for r in feed.typed_events(told).collect()}
    assert sorted(events) == [2, 3]
    assert events[2].order_amount == 7.5 and events[2][S.EXTRA] is None
    assert events[3][S.EXTRA] == {"phone": "5", "tags": '["a"]'}
    refused = [(r.reason, r.record[:20]) for r in feed.refused_elements(told, ntz(AT)).collect()]
    assert sorted(r for r, _ in refused) == [
        "Invalid _row_sequence_id: 'six'", "Invalid order_amount: 'x'", "Unreadable", "Unreadable", "Unreadable", "Unreadable",
    ]
    assert {t for r, t in refused if r == "Unreadable"} == {"9", "null", lines[1][:20], lines[2][:20]}
    assert told.count() == len(events) + len(refused)


def test_an_element_is_parsed_once(spark):
    """A filter on the reason would otherwise parse the element again for each field it names."""
    lines = spark.createDataFrame([('[{"_row_sequence_id": 1, "x": "2"}, 17]',)], "value string")
    for rows in (feed.typed_events(feed.elements(lines)), feed.refused_elements(feed.elements(lines), ntz(AT))):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(MapType") == 1
    assert sorted(r.reason for r in rows.collect()) == ["Missing entity_type", "Unreadable"]


def test_a_pretty_printed_array_with_a_bad_value(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([record(1, "orders", order_amount="x"), record(2)], indent=2))
    told = feed.read_elements(spark, str(tmp_path), whole_file_arrays=True)
    assert [r._row_sequence_id for r in feed.typed_events(told).collect()] == [2]
    assert [r.entity_type for r in feed.refused_elements(told, ntz(AT)).collect()] == ["orders"]


def test_unknown_columns_are_stored_and_reported(spark, tmp_path):
    rows = [record(1, phone="5", Email="clash"), record(2, "orders", phone="6"), record(3, "suppliers", phone="7"), record(4)]
    (tmp_path / "a.json").write_text("\n".join(json.dumps(r) for r in rows))
    events = bronze.stamped(feed.read_change_files(spark, str(tmp_path / "a.json")), ntz(AT), F.lit("b"))
    report = sorted(tuple(r) for r in bronze.drift_report(events).select("entity_type", "column_name", "rows_filled").collect())
    assert report == [("customers", "Email", 1), ("customers", "phone", 1), ("orders", "phone", 1)]
    bronze.write_entities(events, lambda entity: str(tmp_path / entity))
    landed = bronze.read_raw(spark, str(tmp_path / "customers"), "customers", [S.EXTRA]).orderBy("_row_sequence_id")
    assert [r[S.EXTRA] for r in landed.collect()] == [{"phone": "5", "Email": "clash"}, None]


def _log(spark, *rows):
    return spark.createDataFrame(list(rows), "_row_sequence_id long, _commit_timestamp string").withColumn(
        "_commit_timestamp", F.col("_commit_timestamp").cast("timestamp_ntz")
    )


def test_high_water_mark_never_falls(spark):
    log = _log(spark, (5, "2024-01-05"), (7, "2024-01-03"))
    assert tuple(feed.high_water_mark(log).first()) == (7, dt.datetime(2024, 1, 5))
    kept = feed.high_water_mark(log, F.lit(9).cast("long"), ntz("2025-01-01"))
    assert tuple(kept.first()) == (9, dt.datetime(2025, 1, 1))
    assert tuple(feed.high_water_mark(log.limit(0)).first()) == (0, dt.datetime(1970, 1, 1))


def test_extract_above_the_mark_in_order(spark):
    log = _log(spark, (9, "2024-01-05"), (5, "2024-01-05"), (7, "2024-01-03"))
    mark = spark.createDataFrame([(5,)], "last_processed_id long")
    assert [r[0] for r in feed.changes_after(log, mark, ordered=True).collect()] == [7, 9]


def test_extract_reaches_the_scan(spark, lake):
    mark = spark.createDataFrame([(5,)], "last_processed_id long")
    plan = feed.changes_after(lake.raw_orders, mark)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "PushedFilters: [IsNotNull(_row_sequence_id)" in plan


def test_drift_is_per_entity(spark, lake, rows_of):
    assert bronze.drift_columns(["entity_type", "email", "zeta", "alpha", "ingest_date"], "customers") == ["alpha", "zeta"]
    assert bronze.filled_drift(lake.change_log) == {"customers": ["loyalty_tier"], "orders": []}
    rows = bronze.conformed(lake.raw_customers, "customers")
    assert rows.columns == S.landed_columns("customers") + ["loyalty_tier"]


def test_unknown_entities_are_not_written(spark, lake, tmp_path):
    events = lake.change_log.limit(5).withColumn("entity_type", F.lit("suppliers"))
    stamped = bronze.stamped(lake.change_log.unionByName(events), ntz(AT), F.lit("b"))
    bronze.write_entities(stamped, lambda entity: str(tmp_path / entity))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["customers", "orders"]
    landed = sum(bronze.read_merged(spark, str(tmp_path / e)).count() for e in ("customers", "orders"))
    assert landed == lake.change_log.count()
    assert [p.name for p in (tmp_path / "orders").iterdir() if p.is_dir()] == ["ingest_date=2024-01-02"]


def test_clustering_bounds_are_disjoint(spark, lake):
    rows = bronze.clustered(lake.fact_orders, ["customer_sk", "created_at"], 4)
    spans = rows.withColumn("p", F.spark_partition_id()).groupBy("p").agg(
        F.min(F.struct("customer_sk", "created_at")).alias("a"), F.max(F.struct("customer_sk", "created_at")).alias("z")
    ).orderBy("a").collect()
    assert len(spans) > 1
    assert all(tuple(x.z) <= tuple(y.a) for x, y in zip(spans, spans[1:]))
    # the unresolved key fills more than one range
    assert rows.filter("customer_sk = '-1'").select(F.spark_partition_id()).distinct().count() > 1


def test_stream_resumes_and_archives(spark, lake, tmp_path):
    topic, raw, mark, archive = (str(tmp_path / n) for n in ("topic", "raw", "mark", "archive"))
    log = lake.change_log

    def run():
        jobs.ingest_available(spark, topic, raw, mark, ntz(AT), archive)
        return jobs.read_landed(spark, raw, "orders").count()

    feed.append_topic(log.filter("entity_type = 'orders'").limit(10), topic)
    (tmp_path / "topic" / "broken.json").write_text('{"_row_sequence_id": ')
    assert run() == 10
    assert [tuple(r)[1:3] for r in quality.read_documents(spark, f"{raw}/refused").collect()] == [("Unreadable", '{"_row_sequence_id": ')]
    assert run() == 10
    feed.append_topic(log.filter("entity_type = 'orders'").limit(7), topic)
    assert run() == 17
    # files of the first batch were moved when the second began
    assert any(p.name == "broken.json" for p in (tmp_path / "archive").rglob("*.json"))
    assert not (tmp_path / "topic" / "broken.json").exists()


def test_a_replayed_batch_counts_once(spark, lake, tmp_path, rows_of):
    root = str(tmp_path / "state")
    batch = bronze.stamped(lake.change_log, F.col("_commit_timestamp"), F.lit("b"))
    first, second = (batch.filter(f"_commit_timestamp {op} timestamp_ntz'2024-01-15'") for op in ("<", ">="))
    jobs.apply_batch(first, 0, root)
    jobs.apply_batch(second, 1, root)
    history = rows_of(state.read_history(spark, root, 1))
    orders = rows_of(state.read_orders(spark, root, 1))
    jobs.apply_batch(second, 1, root)
    assert rows_of(state.read_history(spark, root, 1)) == history
    assert rows_of(state.read_orders(spark, root, 1)) == orders
    # the state before the batch can still be read
    assert 0 < state.read_history(spark, root, 0).count() < len(history)


def test_topic_files_are_compressed_and_bounded(spark, lake, tmp_path, monkeypatch, rows_of):
    log = lake.change_log.select("_row_sequence_id", "entity_type", "_change_type", "_commit_timestamp")
    monkeypatch.setattr(feed, "FILE_EVENTS", 1000)
    feed.append_topic(log, str(tmp_path / "topic"))
    files = list((tmp_path / "topic").glob("part-*"))
    plain = spark.read.text(str(tmp_path / "topic"))
    assert sum(f.stat().st_size for f in files) * 2 < plain.selectExpr("sum(length(value))").first()[0]
    assert len(files) >= log.count() / 1000
    assert rows_of(feed.read_change_files(spark, str(tmp_path / "topic")), log.columns) == rows_of(log)


def test_what_a_batch_does_not_apply_is_kept_once(spark, tmp_path, rows_of):
    root = str(tmp_path / "state")

    def batch(*rows):
        columns = dict(customer_id=None, order_id=None, order_amount=None)
        lines = spark.createDataFrame([(json.dumps({**columns, **r}),) for r in rows], "value string")
        return bronze.stamped(feed.typed_events(feed.elements(lines)), F.col("_commit_timestamp"), F.lit("b"))

    def at(day, r):
        return {**r, "_commit_timestamp": f"2024-01-{day:02d}T00:00:00"}

    first = batch(at(5, record(1, customer_id="a")), at(5, record(2, customer_id=" ", phone="5")))
    second = batch(at(3, record(3, customer_id="a")), at(6, record(4, "orders", order_id="o", customer_id="a")))
    for epoch, rows in ((0, first), (1, second), (1, second)):
        jobs.apply_batch(rows, epoch, root)
    refused = quality.read_documents(spark, f"{root}/quarantine").orderBy("reason").collect()
    assert [(r.entity_type, r.reason) for r in refused] == [
        ("orders", "Invalid order_amount: Null order amount"), ("customers", "Missing customer_id"),
    ]
    assert json.loads(refused[1].record)[S.EXTRA] == {"phone": "5"}
    assert [(r._row_sequence_id, r.late_reason) for r in state.read_late(spark, root, 1).collect()] == [(3, "NOT_AFTER_OPEN_VERSION")]
    assert state.read_late(spark, root, 0).count() == 0
    assert state.read_history(spark, root, 1).count() == 1


def test_versions_a_batch_does_not_touch_are_not_rewritten(spark, lake, tmp_path):
    root = str(tmp_path / "state")
    batch = bronze.stamped(lake.change_log, F.col("_commit_timestamp"), F.lit("b"))
    jobs.apply_batch(batch, 0, root)
    jobs.apply_batch(batch.limit(0), 1, root)
    written = {p.name for p in (tmp_path / "state" / "history" / "v=1").iterdir() if p.is_dir()}
    assert written == set()
    assert state.read_history(spark, root, 1).exceptAll(state.read_history(spark, root, 0)).count() == 0


def test_orders_from_the_stream_equal_the_batch(spark, lake, tmp_path, rows_of, sf_dir):
    from scenarios.queries import QUERIES

    root = str(tmp_path / "state")
    batch = bronze.stamped(lake.change_log, F.col("_commit_timestamp"), F.lit("b"))
    for epoch, op in enumerate(("<", ">=")):
        jobs.apply_batch(batch.filter(f"_commit_timestamp {op} timestamp_ntz'2024-01-15'"), epoch, root)
    columns = ["order_id", "customer_id", "order_amount", "order_status", "updated_at"]
    assert rows_of(state.read_orders(spark, root, 1), columns) == rows_of(QUERIES["orders_upsert_batch"](spark, sf_dir), columns)


def test_pipeline_runs_twice_and_records_failures(spark, lake, tmp_path):
    schema, audit, events = "twice", str(tmp_path / "audit"), str(tmp_path / "runs")
    spark.sql(f"create database {schema} location '{tmp_path}/db'")
    for _ in range(2):
        names = pipeline.refresh(spark, lake.raw_customers, lake.raw_orders, schema, audit, events)
    assert "fact_orders" in names and "stg_customers" not in names
    assert spark.table(f"{schema}.silver_customers").count() == 278
    assert spark.table("vw_executive_summary").first().total_orders > 0
    checked = {(r.table_name, r.column_name, r.test_name): r.status for r in pipeline.run_checks(spark, schema).collect()}
    assert checked["fact_orders", "customer_sk", "relationships"] == "pass"
    with pytest.raises(Exception):
        pipeline.refresh(spark, lake.raw_customers.drop("email"), lake.raw_orders, schema, audit, events)
    log = spark.read.schema(S.AUDIT_SCHEMA).parquet(audit)
    assert {r.status: r["count"] for r in log.groupBy("status").count().collect()} == {"SUCCESS": 12, "FAILED": 1}
    assert runs.failed(log, "log_id").first().error_message != ""
    counted = log.filter("layer = 'silver' and status = 'SUCCESS' and target_table like '%customers%'").agg(
        F.sum(F.col("records_processed") + F.col("records_quarantined"))
    )
    assert counted.first()[0] == 2 * lake.raw_customers.count()
    runs.append_event(spark, events, "r", "p", "START", dt.datetime(2024, 1, 1))
    states = runs.run_status(spark.read.schema(S.RUN_EVENT_SCHEMA).parquet(events)).orderBy("start_time").collect()
    assert [r.status for r in states] == ["RUNNING", "SUCCESS", "SUCCESS", "FAILED"]
    assert states[1].records_processed == spark.table(f"{schema}.fact_orders").count()
    assert states[3].error_message != "" and states[3].pipeline_name == pipeline.PIPELINE


def test_table_helpers(spark, tmp_path):
    spark.sql(f"create database helpers location '{tmp_path}/db'")
    rows = spark.range(3)
    assert tables.create_if_absent(spark, rows, "helpers.t")
    assert not tables.create_if_absent(spark, rows, "helpers.t")
    tables.insert_overwrite(spark.range(5), "helpers.t")
    assert spark.table("helpers.t").count() == 5
    tables.as_view(rows, "only_a_view")
    assert tables.permanent_tables(spark, "helpers", []) == ["t"]
    assert tables.permanent_tables(spark, "no_such_schema", ["customers", "orders"]) == ["customers", "orders"]


def test_shared_root_is_the_one_the_session_names(spark):
    assert workspace.shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert workspace.new_dir(spark, "x") != workspace.new_dir(spark, "x")


def test_events_must_say_what_changed_when(spark, tmp_path):
    """Eight elements: each is landed, refused or counted for an unknown entity."""
    rows = [
        record(1), {"foo": 1}, {**record(2), "entity_type": None}, {**record(3), "_change_type": " "}, {**record(4), "_row_sequence_id": None},
        {**record(5), "_commit_timestamp": None}, record(6, "suppliers"), record(7, "orders", order_amount="3.5"),
    ]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    told = feed.read_elements(spark, str(tmp_path))
    events = bronze.stamped(feed.typed_events(told), ntz(AT), F.lit("b"))
    bronze.write_entities(events, lambda e: str(tmp_path / "raw" / e))
    landed = sum(bronze.read_raw(spark, str(tmp_path / "raw" / e), e).count() for e in S.ENTITY_COLUMNS)
    refused = sorted(r.reason for r in feed.refused_elements(told, ntz(AT)).collect())
    unknown = [tuple(r) for r in bronze.unknown_entities(events).collect()]
    assert refused == ["Missing _change_type", "Missing _commit_timestamp", *["Missing _row_sequence_id"] * 2, "Missing entity_type"]
    assert unknown == [("suppliers", 1)] and landed == 2 and landed + len(refused) + 1 == told.count() == 8


@pytest.mark.parametrize("amount", ["NaN", "Infinity", "-Infinity", "1e19", "-1e15"])
def test_amounts_that_are_no_money_stop_no_measure(spark, tmp_path, amount):
    from tidelog.plans import gold, kpi, staging

    rows = [record(1, "orders", order_id="o1", customer_id="c", order_amount="2.5", created_at=AT.replace(" ", "T")),
            record(2, "orders", order_id="o2", customer_id="c", order_amount=amount, created_at=AT.replace(" ", "T"))]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    told = feed.read_elements(spark, str(tmp_path))
    assert [r._row_sequence_id for r in feed.typed_events(told).collect()] == [1]
    assert [r.reason for r in feed.refused_elements(told, ntz(AT)).collect()] == [f"Invalid order_amount: '{amount}'"]
    # rows that came to the raw table another way
    raw = bronze.stamped(feed.typed_events(told), ntz(AT), F.lit("b"))
    raw = raw.unionByName(raw.withColumns({"order_id": F.lit("o2"), "order_amount": F.lit(amount).cast("double"), "_row_sequence_id": F.lit(2).cast("long")}))
    assert [r.order_id for r in staging.staged_orders(raw).collect()] == ["o1"]
    assert [r.order_id for r in staging.quarantined_orders(raw).collect()] == ["o2"]
    assert [r.reason[:21] for r in quality.key_quarantine(raw, "orders", ntz(AT)).collect()] == ["Invalid order_amount:"]
    orders = quality.keyed_rows(raw, "orders")
    facts = gold.order_facts(orders, gold.unknown_member(orders))
    assert [(r.total_orders, r.total_revenue) for r in kpi.daily_sales(facts).collect()] == [(1, 2.5)]


def test_streams_count_unknown_entities(spark, tmp_path):
    topic = tmp_path / "topic"
    topic.mkdir()
    (topic / "a.json").write_text("\n".join(json.dumps(record(i, "suppliers" if i % 3 else "orders")) for i in range(9)))
    jobs.ingest_available(spark, str(topic), str(tmp_path / "raw"), str(tmp_path / "mark"), ntz(AT))
    assert [tuple(r) for r in jobs.read_unknown(spark, str(tmp_path / "raw")).collect()] == [("suppliers", 6, 0)]
    assert jobs.read_landed(spark, str(tmp_path / "raw"), "orders").count() == 3


def _files_met(spark, path, column, low, high):
    """Files whose smallest and largest value leave room for the range."""
    spans = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min(column).alias("a"), F.max(column).alias("z"))
    return spans.filter((F.col("a") <= F.lit(high)) & (F.col("z") >= F.lit(low))).count()


def test_interleaved_files_are_narrow_in_both_columns(spark, tmp_path):
    rows = spark.range(40_000).select(
        F.concat(F.lit("c"), F.lpad((F.col("id") * 7919 % 1000).cast("string"), 4, "0")).alias("k"), (F.col("id") * 104_729 % 10_000).alias("at")
    )
    linear, both = str(tmp_path / "linear"), str(tmp_path / "both")
    bronze.clustered(rows, ["k", "at"], 64).write.parquet(linear)
    bronze.interleaved(rows, ["k", "at"], 64).write.parquet(both)
    assert spark.read.parquet(both).exceptAll(rows).count() == 0 and spark.read.parquet(both).count() == 40_000
    key, at = ("k", "c0500", "c0510"), ("at", 5000, 5100)
    assert _files_met(spark, linear, *at) == 64
    assert _files_met(spark, both, *at) <= 16 and _files_met(spark, both, *key) <= 16
    nulls = spark.createDataFrame([(None, 1), ("a", None), (None, None)], "k string, at long")
    assert bronze.interleaved(nulls, ["k", "at"], 4).count() == 3 and bronze.interleaved(nulls.limit(0), ["k", "at"], 4).count() == 0


def test_each_table_is_read_once_for_the_tests(lake):
    from tidelog.plans import checks

    frame = checks.summary(lake.test_tables)
    frame._jdf.collectToPython()
    final = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 6
    assert final.count("Exchange hashpartitioning") == 1
