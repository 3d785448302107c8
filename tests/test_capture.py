"""Snapshot comparison by digests."""

from __future__ import annotations

import pytest

from tidelog.operators import capture

COLUMNS = "k string, a long, b string"


def snapshots(spark, n):
    rows = [(f"k{i}", i, None if i % 7 == 0 else "x") for i in range(n)]
    new = [r for r in rows if r[0] != "k5"] + [("new", 1, None)]
    new = [(k, a + 1, b) if k == "k9" else (k, a, "y") if k == "k14" else (k, a, b) for k, a, b in new]
    return (spark.createDataFrame(r, COLUMNS).repartition(3) for r in (rows, new))


@pytest.mark.parametrize("buckets", [1, 16, 4_096])
def test_digests_find_what_the_whole_comparison_finds(buckets, spark, rows_of):
    old, new = snapshots(spark, 300)
    got = capture.snapshot_changes_by_digest(old, new.select("b", "k", "a"), "k", buckets)
    assert rows_of(got, ["_change_type", "k", "a", "b"]) == rows_of(capture.snapshot_changes(old, new, "k"), ["_change_type", "k", "a", "b"])
    assert got.count() == 6


def test_equal_buckets_leave_before_the_join(spark):
    old, new = snapshots(spark, 5_000)
    unlike = capture.differing(old, new, "k")
    assert 1 <= unlike.count() <= 4
    plan = capture.snapshot_changes_by_digest(old, new, "k")
    assert plan.count() == 6
    assert capture.differing(old, old, "k").count() == 0
    kept = old.withColumn("_bucket", capture._bucket("k", capture.DIGESTS)).join(unlike, "_bucket", "left_semi").count()
    assert kept < 20


def test_empty_snapshots(spark):
    old, new = snapshots(spark, 20)
    none = old.limit(0)
    assert capture.snapshot_changes_by_digest(none, new, "k").filter("_change_type = 'INSERT'").count() == new.count()
    assert capture.snapshot_changes_by_digest(old, none, "k").filter("_change_type = 'DELETE'").count() == old.count()
    assert capture.snapshot_changes_by_digest(none, none, "k").count() == 0
