"""Batch application against a row-by-row model, and the staged merge on hand-made rows."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidelog import schemas as S
from tidelog.operators import merge

BASE = dt.datetime(2024, 1, 1)
SCHEMA = (
    "_row_sequence_id long, entity_type string, _change_type string, _commit_timestamp timestamp_ntz, customer_id string,"
    "first_name string, last_name string, email string, state string, created_at timestamp_ntz, updated_at timestamp_ntz,"
    "_bronze_ingested_at timestamp_ntz, _bronze_batch_id string"
)


def event(seq, kind, minute, key, state=" ny ", batch="b0"):
    at = BASE + dt.timedelta(minutes=minute)
    return (seq, "customers", kind, at, key, " Ann ", None, "a@x.io", state, at, at, at, batch)


def model(open_rows: dict, batch: list[tuple]) -> tuple[list, dict, set]:
    """One event at a time.  open_rows: key -> (valid_from, seq, batch)."""
    closed, late = [], set()
    for seq, _, kind, at, key, *_rest in sorted(batch, key=lambda e: (e[3], e[0])):
        batch_id = _rest[-1]
        key = (key or "").strip()
        if not key or kind == "UPDATE_BEFORE":
            continue
        have = open_rows.get(key)
        if kind == "DELETE":
            if have and at < have[0]:
                late.add(seq)
            elif have:
                closed.append((key, have[0], at, 0, 1, batch_id))
                del open_rows[key]
        else:
            if have and at <= have[0]:
                late.add(seq)
                continue
            if have:
                closed.append((key, have[0], at, 0, 0, have[2]))
            open_rows[key] = (at, seq, batch_id)
    return closed, open_rows, late


def random_batches(seed: int, late: bool) -> list[list[tuple]]:
    rng = random.Random(seed)
    keys = ["a", "b", "c", "hot", " d ", "", None]
    events = []
    for seq in range(400):
        key = "hot" if rng.random() < 0.4 else rng.choice(keys)
        kind = rng.choices(["INSERT", "UPDATE_AFTER", "DELETE", "UPDATE_BEFORE"], [3, 5, 2, 1])[0]
        events.append((seq, kind, rng.randrange(0, 150), key))
    events.sort(key=lambda e: (e[2], e[0]))
    size = len(events) // 3
    parts = [events[:size], events[size : 2 * size], events[2 * size :]]
    # batches must be cut between instants, or a tie would span two of them
    for i in (0, 1):
        while parts[i + 1] and parts[i] and parts[i + 1][0][2] == parts[i][-1][2]:
            parts[i].append(parts[i + 1].pop(0))
    if late:
        moved = rng.sample(parts[0], 20)
        parts[0] = [e for e in parts[0] if e not in moved]
        parts[2] = parts[2] + moved
    return [[event(s, k, m, key, batch=f"b{i}") for s, k, m, key in part] for i, part in enumerate(parts)]


@pytest.mark.parametrize("seed,late,hot", [(2, True, 10**6), (3, True, 7)])
def test_batches_equal_the_row_by_row_model(seed, late, hot, spark, rows_of):
    history = merge.empty_history(spark.range(0))
    opened: dict = {}
    closed: list = []
    for rows in random_batches(seed, late):
        batch = spark.createDataFrame(rows, SCHEMA)
        known = {k: v for k, v in opened.items()}
        got_late = {r[0] for r in rows_of(merge.late_changes(history, batch, hot))}
        done, opened, want_late = model(dict(opened), rows)
        # the one case the set-based rule decides otherwise: a write at exactly the start of a
        # version that a delete of the same instant closes in a later batch
        exempt = {s for s, _, k, at, key, *_ in rows if k != "DELETE" and known.get((key or "").strip(), (None,))[0] == at}
        assert got_late - exempt == want_late - exempt
        closed += done
        history = spark.createDataFrame(merge.merge_history(history, batch, hot).collect(), history.schema)
    end = dt.datetime(9999, 12, 31, 23, 59, 59)
    want = closed + [(k, v[0], end, 1, 0, v[2]) for k, v in opened.items()]
    columns = ["customer_id", "valid_from", "valid_to", "is_current", "is_deleted", "_bronze_batch_id"]
    assert rows_of(history, columns) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_values_are_cleaned_and_keyed(spark):
    import hashlib

    batch = spark.createDataFrame([event(1, "INSERT", 0, " k1 ")], SCHEMA)
    row = merge.apply_changes(merge.empty_history(batch), batch).first()
    assert (row.customer_id, row.first_name, row.last_name, row.state) == ("k1", "Ann", "", "NY")
    assert row.customer_sk == hashlib.md5(b"k1_2024-01-01 00:00:00.000000").hexdigest()


def test_delete_marks_the_open_version_and_a_second_delete_does_nothing(spark, rows_of):
    rows = [event(1, "INSERT", 0, "k"), event(2, "DELETE", 5, "k", batch="b9"), event(3, "DELETE", 6, "k")]
    batch = spark.createDataFrame(rows, SCHEMA)
    got = merge.merge_history(merge.empty_history(batch), batch)
    assert rows_of(got, ["is_current", "is_deleted", "_bronze_batch_id"]) == [(0, 1, "b9")]


def _target(spark):
    batch = spark.createDataFrame(
        [event(1, "INSERT", 0, "stays"), event(2, "INSERT", 0, "moves"), event(3, "INSERT", 0, "goes"),
         event(4, "INSERT", 0, "back"), event(5, "DELETE", 1, "back")],
        SCHEMA,
    )
    return merge.first_load(batch)


def _changes(spark):
    rows = [
        event(10, "UPDATE_BEFORE", 9, "moves"), event(11, "UPDATE_AFTER", 9, "moves", "TX"), event(12, "UPDATE_AFTER", 10, "moves", "FL"),
        event(13, "DELETE", 9, "goes"), event(14, "INSERT", 9, "back"), event(15, "INSERT", 9, "new"), event(16, "DELETE", 9, "never"),
    ]
    return merge.net_changes(spark.createDataFrame(rows, SCHEMA))


def test_staged_changes_add_null_keys_for_known_writes(spark, rows_of):
    got = rows_of(merge.staged_changes(_target(spark), _changes(spark)), ["customer_id", "merge_key"])
    assert got == [
        ("back", "back"), ("goes", "goes"), ("moves", "moves"), ("moves", None), ("moves", None), ("never", "never"), ("new", "new"),
    ]


def test_staged_merge(spark, rows_of):
    got = rows_of(merge.staged_merge(_target(spark), _changes(spark)), ["customer_id", "state", "is_current", "is_deleted"])
    assert got == [
        ("back", " ny ", 0, 1), ("back", " ny ", 1, 0), ("goes", " ny ", 0, 1), ("moves", " ny ", 0, 0),
        ("moves", "FL", 1, 0), ("moves", "TX", 0, 0), ("new", " ny ", 1, 0), ("stays", " ny ", 1, 0),
    ]


@pytest.mark.parametrize("hot", [merge.HOT_ROWS, 2])
def test_staged_merge_in_two_parts_is_the_whole_history(spark, rows_of, hot):
    """Every change of a key counts, whatever part it comes in."""
    rng = random.Random(5)
    rows, known = [], set()
    for seq in range(300):
        key = f"k{rng.randint(0, 12)}"
        kind = rng.choice(["UPDATE_AFTER", "UPDATE_AFTER", "DELETE", "UPDATE_BEFORE"]) if key in known else "INSERT"
        known.add(key)
        rows.append(event(seq, kind, seq, key, rng.choice(["NY", "TX"])))
    first, second = (spark.createDataFrame(part, SCHEMA) for part in (rows[:120], rows[120:]))
    got = merge.staged_merge(merge.first_load(first), second, hot)
    assert rows_of(got) == rows_of(merge.first_load(first.unionByName(second)), got.columns)


def test_stale_changes_are_told_apart(spark, rows_of):
    target = merge.first_load(spark.createDataFrame([event(5, "INSERT", 10, "k")], SCHEMA))
    changes = spark.createDataFrame([event(1, "UPDATE_AFTER", 3, "k"), event(2, "UPDATE_AFTER", 12, "k", "TX")], SCHEMA)
    assert rows_of(merge.stale_changes(target, changes), ["_row_sequence_id"]) == [(1,)]
    got = merge.staged_merge(target, changes)
    assert got.count() == 2 and got.filter("valid_to <= valid_from").count() == 0


ORDER = "_row_sequence_id long, _change_type string, _commit_timestamp timestamp_ntz, order_id string, order_status string"


def test_upserts(spark, rows_of):
    at = [BASE + dt.timedelta(hours=h) for h in range(4)]
    target = spark.createDataFrame([(1, "INSERT", at[0], "o1", "Pending"), (2, "INSERT", at[0], "o2", "Pending")], ORDER)
    batch = spark.createDataFrame(
        [(3, "UPDATE_AFTER", at[1], "o1", "Shipped"), (4, "DELETE", at[2], "o1", "Shipped"), (5, "INSERT", at[1], "o3", "Pending"),
         (6, "UPDATE_AFTER", at[1], "o3", "Shipped")],
        ORDER,
    )
    columns = ["order_id", "order_status", "_change_type"]
    assert rows_of(merge.upsert_changes(target, batch, "order_id"), columns) == [
        ("o2", "Pending", "INSERT"), ("o3", "Shipped", "UPDATE_AFTER"),
    ]
    assert rows_of(merge.upsert_changes(target, batch, "order_id", apply_deletes=False), columns) == [
        ("o1", "Shipped", "DELETE"), ("o2", "Pending", "INSERT"), ("o3", "Shipped", "UPDATE_AFTER"),
    ]
    newer = target.filter("order_id = 'o2'").withColumn("order_status", F.lit("Delivered"))
    assert rows_of(merge.upsert(target, newer, "order_id"), ["order_id", "order_status"]) == [
        ("o1", "Pending"), ("o2", "Delivered"),
    ]


def test_unknown_change_kinds_are_ignored(spark):
    batch = spark.createDataFrame([event(1, "TRUNCATE", 0, "k")], SCHEMA)
    assert merge.apply_changes(merge.empty_history(batch), batch).count() == 0
    assert S.UPDATE_BEFORE == "UPDATE_BEFORE"


@pytest.mark.parametrize("hot", [merge.HOT_ROWS, 2])
def test_staged_changes_are_what_the_merge_applies(spark, rows_of, hot):
    """Rows under a key end a current version or insert; rows under NULL insert: versions and source agree."""
    rng = random.Random(8)
    rows = [event(seq, rng.choice(["INSERT", "UPDATE_AFTER", "DELETE"]), seq // 2, f"k{rng.randint(0, 6)}") for seq in range(120)]
    target = merge.first_load(spark.createDataFrame(rows[:50], SCHEMA))
    target = spark.createDataFrame(target.collect(), target.schema)
    changes = spark.createDataFrame(rows[40:], SCHEMA)
    source = merge.staged_changes(target, changes, hot)
    assert source.filter("merge_key is not null").groupBy("merge_key").count().filter("count > 1").count() == 0
    stale = {r._row_sequence_id for r in merge.stale_changes(target, changes, hot).collect()}
    assert stale and stale.isdisjoint(r._row_sequence_id for r in source.collect())
    known = {r.customer_id for r in target.filter("is_current = 1").collect()}
    inserted = [r for r in source.collect() if r._change_type != "DELETE" and (r.merge_key is None or r.customer_id not in known)]
    merged = merge.staged_merge(target, changes, hot)
    assert merged.count() == target.count() + len(inserted)
    begun = {(r.customer_id, r.valid_from) for r in target.filter("is_current = 1").collect()}
    closed = {r.customer_id for r in merged.filter("is_current = 0").collect() if (r.customer_id, r.valid_from) in begun}
    assert closed == {r.merge_key for r in source.collect()} & known
