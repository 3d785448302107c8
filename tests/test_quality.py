from __future__ import annotations

import json

from pyspark.sql import functions as F

from scenarios.feed import STAMP, ntz
from tidelog.functions import columns as C
from tidelog.operators import quality
from tidelog.plans import staging


def test_customer_rules(spark, rows_of):
    rows = spark.createDataFrame(
        [("uuid-1", "valid@example.com", "NY"), (None, "nullpk@example.com", "CA"), ("uuid-2", "invalid_email.com", "TX"),
         ("uuid-3", "valid2@example.com", "CAL"), ("uuid-4", None, None), ("uuid-5", "at@nodot", "NY"),
         (None, "bad", "CAL"), ("uuid-6", "bad", "CAL"), ("uuid-7", "a@b.c", " N")],
        "customer_id string, email string, state string",
    )
    clean, bad = quality.split_by_rules(rows, "customers", ntz(STAMP))
    assert rows_of(clean, ["customer_id"]) == [("uuid-1",), ("uuid-4",), ("uuid-7",)]
    assert clean.columns == rows.columns
    # the first rule that fails names the reason
    assert rows_of(bad, ["customer_id", "email", "_quarantine_reason"]) == [
        ("uuid-2", "invalid_email.com", "INVALID_EMAIL"), ("uuid-3", "valid2@example.com", "INVALID_STATE_CODE"),
        ("uuid-5", "at@nodot", "INVALID_EMAIL"), ("uuid-6", "bad", "INVALID_EMAIL"),
        (None, "bad", "NULL_PK"), (None, "nullpk@example.com", "NULL_PK"),
    ]
    assert bad.columns == [*rows.columns, "_quarantine_reason", "_dq_failed", "_quarantined_at"]


def test_order_rules(spark, rows_of):
    rows = spark.createDataFrame([("o1", 100.5), ("o2", -50.0), (None, 20.0), ("o3", None)], "order_id string, order_amount double")
    clean, bad = quality.split_by_rules(rows, "orders", ntz(STAMP))
    assert rows_of(clean, ["order_id"]) == [("o1",), ("o3",)]
    assert rows_of(bad, ["order_id", "_quarantine_reason"]) == [("o2", "NEGATIVE_AMOUNT"), (None, "NULL_PK")]


def test_amounts_may_be_text(spark, rows_of):
    rows = spark.createDataFrame(
        [("o1", "c", "12.5"), ("o2", "c", "-1"), ("o3", "c", "abc"), ("o4", "c", None), ("o5", "c", "NaN"), ("  ", "c", "1"), ("o6", "", "1")],
        "order_id string, customer_id string, order_amount string",
    )
    clean, bad = quality.split_by_rules(rows, "orders", ntz(STAMP))
    assert rows_of(bad, ["order_id"]) == [("o2",)]
    refused = quality.key_quarantine(rows, "orders", ntz(STAMP))
    reasons = {json.loads(r.record)["order_id"]: r.reason for r in refused.collect()}
    assert reasons == {
        "o3": "Invalid order_amount: could not convert string to float: 'abc'",
        "o4": "Invalid order_amount: Null order amount",
        "o5": "Invalid order_amount: Null order amount",
        "  ": "Missing order_id",
        "o6": "Missing customer_id",
    }
    assert rows_of(quality.keyed_rows(rows, "orders"), ["order_id"]) == [("o1",), ("o2",)]


def test_refused_records_keep_null_fields(spark):
    rows = spark.createDataFrame([(None, "x")], "customer_id string, state string")
    record = json.loads(quality.key_quarantine(rows, "customers", ntz(STAMP)).first().record)
    assert record == {"customer_id": None, "state": "x"}


def test_refused_documents_of_a_repeated_batch_are_replaced(spark, lake, tmp_path):
    documents = quality.key_quarantine(lake.raw_orders, "orders", ntz(STAMP))
    for _ in range(2):
        quality.write_documents(documents, str(tmp_path), "b1")
    stored = spark.read.json(str(tmp_path))
    assert stored.count() == documents.count() > 0
    assert {"entity_type", "reason", "record", "quarantined_at"} <= set(stored.columns)


def test_unknown_entity_passes_through(spark):
    rows = spark.range(3)
    clean, bad = quality.split_by_rules(rows, "suppliers", ntz(STAMP))
    assert clean.count() == 3
    assert bad.count() == 0


def test_staging_leaves_null_on_neither_side(spark, lake, rows_of):
    raw = lake.raw_customers
    nothing = raw.filter("email is null and state is not null").count()
    assert nothing > 0
    sides = staging.staged_customers(raw).count() + staging.quarantined_customers(raw).count()
    assert sides + nothing == raw.count()
    orders = lake.raw_orders
    no_amount = orders.filter("order_amount is null").count()
    assert staging.staged_orders(orders).count() + staging.quarantined_orders(orders).count() + no_amount == orders.count()


def test_masks(spark):
    rows = spark.createDataFrame(
        [("ann.lee@mail.org", "Lee"), ("a@b.com", "L"), ("x@y@z", ""), ("none", None), (None, "Ng")], "email string, last_name string"
    )
    got = [tuple(r) for r in rows.select(C.masked_email("email"), C.masked_last_name("last_name")).collect()]
    assert got == [
        ("an***@mail.org", "L."), ("a@***@b.com", "L."), ("x@***@y@z", "."), ("***", None), ("***", "N."),
    ]


def test_counts_per_run(spark):
    rows = spark.createDataFrame([("o1", 1.0), ("o2", -1.0)], "order_id string, order_amount double")
    assert tuple(quality.rule_counts(rows, "orders", "t").first()) == ("t", 1, 1)
    assert tuple(quality.rule_counts(rows.filter(F.lit(False)), "orders", "t").first()) == ("t", 0, 0)
