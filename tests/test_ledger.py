"""Landed and applied batches, the bucketed state, facts from a batch."""

from __future__ import annotations

import datetime as dt
import json
import random
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from scenarios.feed import WEEKS, ntz
from tidelog import schemas as S
from tidelog import workspace
from tidelog.plans import gold, increments, state
from tidelog.sources import bronze, feed, ledger
from tidelog.streaming import jobs

MONDAY = dt.datetime(2024, 1, 8)


def events(spark, *rows):
    """Events of a feed from dictionaries, as files would give them."""
    lines = spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")
    return feed.typed_events(feed.elements(lines))


def customer(seq, key, day, kind="INSERT", **more):
    return {"_row_sequence_id": seq, "entity_type": "customers", "_change_type": kind, "_commit_timestamp": f"2024-01-{day:02d}T00:00:00", "customer_id": key, **more}


def order(seq, key, buyer, day, kind="INSERT", amount=5.0):
    at = f"2024-01-{day:02d}T12:00:00"
    return {"_row_sequence_id": seq, "entity_type": "orders", "_change_type": kind, "_commit_timestamp": at, "order_id": key, "customer_id": buyer, "order_amount": amount, "created_at": at}


@pytest.fixture
def places(tmp_path):
    return tuple(str(tmp_path / n) for n in ("raw", "lists", "state"))


def test_batches_wait_until_they_are_applied_in_the_order_of_landing(spark, places):
    raw, lists, root = places
    assert ledger.pending(spark, lists, "silver").count() == 0
    for day, batch in ((9, "second"), (8, "first"), (10, "third")):
        ledger.land(events(spark, customer(day, "a", day, state=batch)), batch, dt.datetime(2024, 1, day), raw, lists)
    assert [r[ledger.BATCH] for r in ledger.pending(spark, lists, "silver").collect()] == ["first", "second", "third"]
    assert increments.apply_pending(spark, raw, lists, root, limit=1) == ["first"]
    assert increments.apply_pending(spark, raw, lists, root) == ["second", "third"]
    assert increments.apply_pending(spark, raw, lists, root) == []
    assert ledger.pending(spark, lists, "another-job").count() == 3
    assert sorted((r.version, r[ledger.BATCH]) for r in ledger.applied(spark, lists, "silver").collect()) == [(0, "first"), (1, "second"), (2, "third")]
    rows = state.read_history(spark, root, 2).orderBy("valid_from").collect()
    assert [(r.state, r.is_current) for r in rows] == [("FIRST", 0), ("SECOND", 0), ("THIRD", 1)]


def test_listing_reads_no_raw_rows(spark, lake):
    raw, lists = lake.landed()
    plan = ledger.pending(spark, lists, "no-job")._jdf.queryExecution().executedPlan().toString()
    assert raw not in plan and "landed" in plan


def test_a_batch_is_read_from_its_own_folder(spark, lake):
    raw, lists = lake.landed()
    files = ledger.read_batch(spark, raw, lists, "orders", "week-2").inputFiles()
    assert files and all("_bronze_batch_id=week-2/" in f for f in files)


def test_landing_again_replaces_the_batch(spark, places, rows_of):
    raw, lists, _ = places
    ledger.land(events(spark, customer(1, "a", 8), customer(2, "b", 9)), "one", MONDAY, raw, lists)
    before = rows_of(ledger.read_raw(spark, raw, lists, "customers"))
    for _ in range(2):
        ledger.land(events(spark, customer(1, "a", 8), customer(2, "b", 9)), "one", MONDAY, raw, lists)
    assert rows_of(ledger.read_raw(spark, raw, lists, "customers")) == before and len(before) == 2
    assert ledger.landed(spark, lists).agg(F.sum("row_count")).first()[0] == 2


def test_names_that_a_folder_would_change_are_refused(spark, places):
    raw, lists, _ = places
    for name in ("", "a/b", "a=b", "..", "a b"):
        with pytest.raises(ValueError):
            ledger.land(events(spark, customer(1, "a", 8)), name, MONDAY, raw, lists)


def test_a_job_killed_before_the_record_changes_nothing(spark, places, rows_of, monkeypatch):
    raw, lists, root = places
    for day in (8, 9, 10):
        ledger.land(events(spark, customer(day, "a", day), customer(day + 50, f"k{day}", day), order(day + 90, "o", "a", day)), f"b{day}", dt.datetime(2024, 1, day), raw, lists)
    clean = f"{root}-clean"
    increments.apply_pending(spark, raw, lists, clean, "clean")

    record = ledger.record_applied

    def killed(*args):
        if args[3] == "b9":
            raise KeyboardInterrupt
        record(*args)

    monkeypatch.setattr(ledger, "record_applied", killed)
    with pytest.raises(KeyboardInterrupt):
        increments.apply_pending(spark, raw, lists, root)
    monkeypatch.setattr(ledger, "record_applied", record)
    assert increments.apply_pending(spark, raw, lists, root) == ["b9", "b10"]
    for read in (state.read_history, state.read_orders, state.read_late):
        assert rows_of(read(spark, root, 2)) == rows_of(read(spark, clean, 2))


def test_a_batch_of_one_key_rewrites_one_bucket(spark, places):
    _, _, root = places

    def apply(version, *rows):
        batch = bronze.stamped(events(spark, *rows), F.col("_commit_timestamp"), F.lit(f"b{version}"))
        jobs.apply_batch(batch, version, root, buckets=16)

    apply(0, *[customer(i, f"k{i}", 8) for i in range(100)])
    folders = lambda v: sorted(p.relative_to(f"{root}/history/v={v}").as_posix() for p in Path(root, "history", f"v={v}").rglob("bucket=*"))
    assert len(folders(0)) == 16
    apply(1, customer(200, "k7", 9, "UPDATE_AFTER", state="TX"))
    bucket = next(f for f in folders(1) if f.startswith("is_current=1"))
    assert folders(1) == ["is_current=0/bucket=-1", bucket]
    held = spark.read.parquet(f"{root}/history/v=0/{bucket}").count()
    assert spark.read.parquet(f"{root}/history/v=1/{bucket}").count() == held < 20
    now, _ = state._manifest(spark, root, 1, 16)
    assert sorted(now) == [0] * 15 + [1]
    # all buckets together are the whole state, and only folders of the manifest are read
    rows = state.read_history(spark, root, 1)
    assert rows.filter("is_current = 1").count() == 100 and rows.count() == 101
    files = [f for f in rows.inputFiles() if "is_current=1" in f]
    assert len({f.rsplit("/", 1)[0] for f in files}) == 16


def test_a_bucket_without_open_versions(spark, places):
    _, _, root = places
    for version, row in enumerate([customer(1, "a", 8), customer(2, "a", 9, "DELETE"), customer(3, "a", 10)]):
        jobs.apply_batch(bronze.stamped(events(spark, row), F.col("_commit_timestamp"), F.lit("b")), version, root, buckets=4)
    assert [max(state._manifest(spark, root, v, 4)[0]) for v in range(3)] == [0, -1, 2]
    assert [state.read_history(spark, root, v).count() for v in range(3)] == [1, 1, 2]
    with pytest.raises(ValueError):
        jobs.apply_batch(bronze.stamped(events(spark, customer(4, "a", 11)), F.col("_commit_timestamp"), F.lit("b")), 3, root, buckets=8)


def random_batch(rng, day, n, next_seq):
    rows = []
    for seq in range(next_seq, next_seq + n):
        key, at = f"c{rng.randint(0, 12)}", max(1, day - rng.choice([0, 0, 0, 2]))
        if rng.random() < 0.5:
            rows.append(customer(seq, key, at, rng.choice(["INSERT", "UPDATE_AFTER", "UPDATE_AFTER", "DELETE"]), state=rng.choice(["NY", "TX"])))
        else:
            rows.append(order(seq, f"o{rng.randint(0, 30)}", key, at, rng.choice(["INSERT", "UPDATE_AFTER", "DELETE"]), rng.randint(1, 90) / 4))
    return rows


def test_facts_of_batches_equal_a_rebuild(spark, places, rows_of, monkeypatch):
    """Random batches with late changes: after each, the kept facts are those of a rebuild, and compacted orders change nothing."""
    monkeypatch.setattr(state, "COMPACT_EVERY", 2)
    raw, lists, root = places
    rng, facts = random.Random(4), None
    for version in range(5):
        ledger.land(events(spark, *random_batch(rng, 6 + 3 * version, 60, 100 * version)), f"b{version}", MONDAY + dt.timedelta(days=version), raw, lists)
        increments.apply_pending(spark, raw, lists, root, buckets=4)
        orders = state.read_orders(spark, root, version)
        dimension = gold.customer_dimension(state.read_history(spark, root, version))
        rebuilt = gold.order_facts(orders, dimension)
        if facts is not None:
            changed = state.changed_orders(spark, root, version), state.changed_versions(spark, root, version)
            for hot in (10**6, 3):
                facts_now = gold.facts_after_batch(facts, orders, dimension, *changed, hot_rows=hot)
                assert rows_of(facts_now, rebuilt.columns) == rows_of(rebuilt)
        facts = spark.createDataFrame(rebuilt.collect(), rebuilt.schema)
    assert Path(root, "orders-base", "v=3").exists() and state._manifest(spark, root, 4, 4)[1] == 3


def test_untouched_facts_stay_as_they_are(spark, places):
    """Only orders of the batch, and those since a customer's change, are resolved again."""
    facts = spark.createDataFrame([("o1", "kept", 1, 1.0, "Pending", MONDAY), ("o2", "old", 1, 1.0, "Pending", MONDAY + dt.timedelta(days=3))],
                                  "order_id string, customer_sk string, date_key int, order_amount double, order_status string, created_at timestamp_ntz")
    orders = facts.withColumn("customer_id", F.lit("c"))
    dimension = spark.createDataFrame([("new", "c", MONDAY - dt.timedelta(days=9), dt.datetime(2030, 1, 1))], "customer_sk string, customer_id string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    since = spark.createDataFrame([("c", MONDAY + dt.timedelta(days=1))], "customer_id string, since timestamp_ntz")
    got = gold.facts_after_batch(facts, orders, dimension, orders.select("order_id").limit(0), since)
    assert {r.order_id: r.customer_sk for r in got.collect()} == {"o1": "kept", "o2": "new"}


def test_increments_prune_by_the_ranges_of_the_ledger(spark, places):
    raw, lists, _ = places
    for day in range(8, 13):
        rows = [order(1000 * day + i, f"o{day}-{i}", "c", day) for i in range(20)]
        ledger.land(events(spark, *rows), f"b{day}", dt.datetime(2024, 1, day), raw, lists, F.col("_commit_timestamp"))
    got = ledger.changes_after(spark, raw, lists, "orders", 11_010)
    assert sorted(r._row_sequence_id for r in got.collect()) == [*range(11_011, 11_020), *range(12_000, 12_020)]
    plan = got._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "dynamicpruning" in text
    read = [s for s in text.splitlines() if "FileScan parquet" in s and "_row_sequence_id" in s]
    assert read and all("dynamicpruning" in s.split("PartitionFilters:")[1] for s in read)
    # of five dates, the last two are read
    scans = []

    def walk(node):
        name = node.nodeName()
        if "Scan parquet" in name:
            scans.append((node.relation().location().rootPaths().mkString(","), node.metrics()))
        inner = node.executedPlan() if name == "AdaptiveSparkPlan" else node.plan() if name.endswith("QueryStage") else None
        for child in [inner] if inner is not None else [node.children().apply(i) for i in range(node.children().size())]:
            walk(child)

    again = ledger.changes_after(spark, raw, lists, "orders", 11_010)
    again._jdf.collectToPython()
    walk(again._jdf.queryExecution().executedPlan())
    assert [m.apply("numPartitions").value() for path, m in scans if path.endswith("/raw/orders")] == [2]


def test_columns_come_from_the_ledger(spark, places, rows_of):
    raw, lists, _ = places
    ledger.land(events(spark, customer(1, "a", 8)).drop(S.EXTRA), "b1", MONDAY, raw, lists)
    ledger.land(events(spark, customer(2, "b", 9, loyalty_tier="gold")).drop(S.EXTRA), "b2", MONDAY + dt.timedelta(days=1), raw, lists)
    assert ledger.known_columns(spark, lists, "customers")[-1] == "loyalty_tier"
    assert rows_of(ledger.schema_log(spark, lists)) == [("customers", "loyalty_tier", "b2")]
    assert [(r.customer_id, r.loyalty_tier) for r in ledger.read_raw(spark, raw, lists, "customers").orderBy("customer_id").collect()] == [("a", None), ("b", "gold")]
    assert ledger.read_raw(spark, raw, lists, "orders").count() == 0


def test_a_backlog_is_applied_in_bounded_batches(spark, tmp_path, lake, rows_of):
    """Ten files, three at a time, are four batches; the state is that of one batch."""
    log = lake.change_log.orderBy("_commit_timestamp", "_row_sequence_id").collect()
    size = -(-len(log) // 10)
    topic = tmp_path / "topic"
    topic.mkdir()
    for i in range(10):
        part = spark.createDataFrame(log[i * size : (i + 1) * size], lake.change_log.schema)
        lines = part.select(F.to_json(F.struct(*part.columns), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})).collect()
        (topic / f"f{i}.json").write_text("\n".join(r[0] for r in lines))
        import os
        os.utime(topic / f"f{i}.json", (1_700_000_000 + i * 10,) * 2)
    for name, limit, batches in (("small", 3, 4), ("whole", None, 1)):
        jobs.apply_available(spark, str(topic), f"{tmp_path}/{name}", f"{tmp_path}/{name}-mark", files_per_batch=limit)
        assert len(list(Path(tmp_path, name, "manifest").glob("v=*"))) == batches
    columns = [c for c in state.read_history(spark, f"{tmp_path}/whole", 0).columns if c != ledger.BATCH]
    assert rows_of(state.read_history(spark, f"{tmp_path}/small", 3), columns) == rows_of(state.read_history(spark, f"{tmp_path}/whole", 0), columns)
    orders = [c for c in state.read_orders(spark, f"{tmp_path}/whole", 0).columns if c != ledger.BATCH]
    assert rows_of(state.read_orders(spark, f"{tmp_path}/small", 3), orders) == rows_of(state.read_orders(spark, f"{tmp_path}/whole", 0), orders)


def test_weeks_of_the_scenario(spark, lake):
    raw, lists = lake.landed()
    assert ledger.landed(spark, lists).select(ledger.BATCH).distinct().count() == WEEKS
    assert ledger.landed(spark, lists).agg(F.sum("row_count")).first()[0] == lake.change_log.count()
    assert ntz("2024-01-01") is not None


def test_independent_steps_run_at_the_same_time(spark):
    meet, ended = threading.Barrier(2, timeout=30), []

    def fails():
        meet.wait()
        raise ValueError("first")

    def goes_on():
        meet.wait()
        ended.append(spark.range(3).count())

    with pytest.raises(ValueError, match="first"):
        workspace.side_by_side(spark, fails, goes_on)
    assert ended == [3]


def test_orders_resolved_again_are_kept(spark, tmp_path):
    """What is resolved again is kept, so the facts it makes do not come from all orders again."""
    at = dt.datetime(2024, 1, 9)
    names = "order_id string, customer_id string, order_amount double, order_status string, created_at timestamp_ntz"
    path = str(tmp_path / "all-orders")
    spark.createDataFrame([("o1", "a", 1.0, "Pending", at), ("o2", "b", 2.0, "Pending", at)], names).write.parquet(path)
    orders = spark.read.schema(names).parquet(path)
    dimension = gold.unknown_member(spark.range(0)).filter("customer_id is null")
    facts = gold.order_facts(orders.filter("order_id = 'o1'"), dimension)
    versions = spark.createDataFrame([], "customer_id string, since timestamp_ntz")
    after = gold.facts_after_batch(facts, orders, dimension, spark.createDataFrame([("o2",)], "order_id string"), versions)
    assert sorted(r.order_id for r in after.collect()) == ["o1", "o2"]
    assert len([f for f in after.inputFiles() if "orders-resolved" in f]) > 0
