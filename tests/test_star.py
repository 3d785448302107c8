from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from scenarios.feed import ntz
from tidelog.operators import asof, history
from tidelog.plans import checks, gold, kpi, runs

BASE = dt.datetime(2024, 1, 1)
END = dt.datetime(9999, 12, 31, 23, 59, 59)


def at(minute: int) -> dt.datetime:
    return BASE + dt.timedelta(minutes=minute)


VERSIONS = "customer_id string, customer_sk string, valid_from timestamp_ntz, valid_to timestamp_ntz"
FACTS = "order_id string, customer_id string, created_at timestamp_ntz"


def random_case(seed: int):
    rng = random.Random(seed)
    versions, facts = [], []
    for key in ["a", "b", "hot", "only"]:
        times = sorted(rng.randrange(0, 300) for _ in range(60 if key == "hot" else 6))
        for i, start in enumerate(times):
            if rng.random() < 0.2:
                continue  # a gap
            stop = at(times[i + 1]) if i + 1 < len(times) else END
            versions.append((key, f"{key}{i}", at(start), stop))
    for i in range(400):
        key = rng.choice(["a", "b", "hot", "hot", "hot", "none", None])
        facts.append((f"o{i}", key, at(rng.randrange(-5, 310))))
    return versions, facts


@pytest.mark.parametrize("seed,hot", [(1, 10**6), (2, 9), (3, 30)])
@pytest.mark.parametrize("closed", [False, True])
def test_point_in_time_join_equals_all_pairs(seed, hot, closed, spark, rows_of):
    versions, facts = random_case(seed)
    want = []
    for order, key, when in facts:
        hits = [sk for k, sk, a, z in versions if k == key and a <= when and (when <= z if closed else when < z)]
        want += [(order, sk) for sk in hits] or [(order, None)]
    got = asof.asof_versions(
        spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS), "customer_id", "created_at",
        ["customer_sk"], hot, closed,
    )
    assert rows_of(got, ["order_id", "customer_sk"]) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_zero_length_versions_never_match(spark, rows_of):
    versions = spark.createDataFrame([("a", "zero", at(5), at(5)), ("a", "real", at(5), at(9))], VERSIONS)
    facts = spark.createDataFrame([("o1", "a", at(5)), ("o2", "a", at(9)), ("o3", "a", at(4))], FACTS)
    got = asof.asof_versions(facts, versions, "customer_id", "created_at", ["customer_sk"])
    assert rows_of(got, ["order_id", "customer_sk"]) == [("o1", "real"), ("o2", None), ("o3", None)]


def test_history_of_three_events(spark, rows_of):
    rows = [
        (1, "customers", "INSERT", at(600), "cust-001", "J", "Doe", "john@x.com", "il"),
        (2, "customers", "INSERT", at(660), "cust-002", "K", "Roe", "kim@x.com", "TX"),
        (3, "customers", "UPDATE_AFTER", at(720), "cust-001", "J", "Doe", "john@x.com", "CA"),
        (4, "orders", "INSERT", at(730), "cust-001", None, None, None, None),
    ]
    schema = (
        "_row_sequence_id long, entity_type string, _change_type string, _commit_timestamp timestamp_ntz, customer_id string,"
        "first_name string, last_name string, email string, state string"
    )
    got = history.customer_history_by_instant(spark.createDataFrame(rows, schema))
    assert rows_of(got, ["customer_sk", "last_name", "email", "state", "valid_to", "is_current"]) == [
        ("cust-001_20240101100000", "D.", "jo***@x.com", "IL", at(720), 0),
        ("cust-001_20240101120000", "D.", "jo***@x.com", "CA", END, 1),
        ("cust-002_20240101110000", "R.", "ki***@x.com", "TX", END, 1),
    ]


def test_date_dimension_has_every_day_of_six_years(spark):
    dates = gold.date_dimension(F.lit("2025-01-01").cast("date"), F.lit("2030-12-31").cast("date"), spark.range(1))
    assert dates.count() == 2191
    first, last = dates.orderBy("date_key").first(), dates.orderBy(F.desc("date_key")).first()
    assert tuple(first) == (20250101, dt.date(2025, 1, 1), 1, 1, 2025, 1)
    assert tuple(last) == (20301231, dt.date(2030, 12, 31), 31, 12, 2030, 4)


def _facts(spark, keys):
    rows = [(f"o{i}", k, 20240101, 10.0, "Pending", at(i)) for i, k in enumerate(keys)]
    schema = (
        "order_id string, customer_sk string, date_key int, order_amount double, order_status string, created_at timestamp_ntz"
    )
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize(
    "keys,level,share",
    [(["-1"] * 2 + ["a"] * 8, "critical", 20.0), (["-1"] + ["a"] * 9, "warning", 10.0), (["a"], "ok", 0.0), ([], "ok", None)],
)
def test_alert_levels(keys, level, share, spark):
    row = kpi.alert_level(kpi.unresolved_orders(_facts(spark, keys))).first()
    assert (row.alert_level, row.unresolved_percentage) == (level, share)


def test_empty_lake_gives_an_empty_document(spark, lake):
    facts = _facts(spark, [])
    no_runs = runs.run_status(lake.run_events).limit(0)
    text = kpi.dashboard_document(facts, lake.dim_customers.limit(0), no_runs, ntz("2024-02-01")).first().document
    document = json.loads(text)
    assert document["executive_summary"] == {
        "total_sales": 0.0, "total_orders": 0, "unique_customers": 0, "unique_customer_keys": 0
    }
    assert document["unresolved_orders"] == {"count": 0, "percentage": 0.0}
    assert document["sales_by_state"] == document["pipeline_runs"] == []


def test_namesakes_can_be_merged(spark, rows_of):
    dimension = spark.createDataFrame(
        [("s1", "c1", "A", "B.", "NY"), ("s2", "c2", "A", "B.", "NY"), ("s3", "c1", "A", "B.", "TX")],
        "customer_sk string, customer_id string, first_name string, last_name string, state string",
    )
    current = dimension.filter("state = 'NY'")
    facts = _facts(spark, ["s1", "s2", "s3", "s3", "-1"])
    by_key = kpi.top_customers(facts, dimension, current)
    assert [(r.customer_id, r.total_orders, r.lifetime_value) for r in by_key.collect()] == [("c1", 3, 30.0), ("c2", 1, 10.0)]
    by_name = kpi.top_customers(facts, dimension, current, by_name=True)
    assert [(r.first_name, r.total_orders, r.lifetime_value) for r in by_name.collect()] == [("A", 4, 40.0)]
    assert kpi.top_customers(facts, dimension, current, n=1).count() == 1


def test_not_in_is_unknown_with_a_null_key(spark):
    keys = spark.createDataFrame([("a",), ("b",)], "customer_sk string")
    facts = _facts(spark, ["a", "x", "x", "y"])
    assert checks.orphaned_facts(facts, keys).first().orphaned_count == 3
    with_null = keys.unionByName(spark.createDataFrame([(None,)], "customer_sk string"))
    assert checks.orphaned_facts(facts, with_null).first().orphaned_count == 0
    assert checks.relationship(facts, with_null).first().failures == 3


def test_data_tests_find_what_is_wrong(spark, lake):
    bad = _facts(spark, ["a", None, "zz"]).withColumn(
        "order_status", F.when(F.col("order_id") == "o0", "Lost").otherwise(F.col("order_status"))
    )
    tables = dict(lake.test_tables, fact_orders=bad.unionByName(bad))
    found = {(r.table_name, r.column_name, r.test_name): (r.failures, r.status) for r in checks.summary(tables).collect()}
    assert len(found) == 14
    assert found["fact_orders", "customer_sk", "not_null"] == (2, "fail")
    assert found["fact_orders", "order_id", "unique"] == (3, "fail")
    assert found["fact_orders", "order_status", "accepted_values"] == (2, "fail")
    assert found["fact_orders", "customer_sk", "relationships"] == (4, "fail")
    assert found["silver_orders", "order_amount", "non_negative"] == (0, "pass")


def test_run_status_of_running_and_finished_runs(spark):
    rows = [
        ("r1", "p", "START", at(0), None, None), ("r1", None, "SUCCESS", at(2), 7, None),
        ("r2", "p", "START", at(1), None, None), ("r2", None, "FAILED", at(3), None, "boom"), ("r3", "p", "START", at(5), None, None),
    ]
    events = spark.createDataFrame(
        rows, "run_id string, pipeline_name string, kind string, at timestamp_ntz, records_processed long, error_message string"
    )
    status = runs.run_status(events)
    got = {r.run_id: (r.status, r.duration_seconds, r.records_processed, r.error_message) for r in status.collect()}
    assert got == {"r1": ("SUCCESS", 120.0, 7, None), "r2": ("FAILED", 120.0, 0, "boom"), "r3": ("RUNNING", None, 0, None)}
    assert [r.run_id for r in runs.recent_runs(status, 2).collect()] == ["r3", "r2"]
    alert = runs.alerts(runs.failed(status, "run_id")).first()
    assert (alert.pipeline, alert.run_id, alert.error) == ("p", "r2", "boom")
