"""Change capture: turning two states of a table into change events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog import schemas as S
from tidelog.operators.skew import HOT_ROWS, spread_lookup


def snapshot_changes(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """INSERT, DELETE and UPDATE_BEFORE / UPDATE_AFTER pairs between two snapshots unique on ``key``."""
    columns = old.columns
    before = old.select(key, F.struct(*columns).alias("_before"))
    after = new.select(key, F.struct(*columns).alias("_after"))
    both = before.join(after, key, "full_outer")
    differs = reduce(
        lambda a, b: a | b, [~F.col("_before")[c].eqNullSafe(F.col("_after")[c]) for c in columns if c != key]
    )
    was, now = F.col("_before").isNotNull(), F.col("_after").isNotNull()

    def image(kind: str, side: str):
        return F.struct(F.lit(kind).alias("_change_type"), F.col(side).alias("row"))

    events = (
        F.when(~was, F.array(image(S.INSERT, "_after")))
        .when(~now, F.array(image(S.DELETE, "_before")))
        .when(differs, F.array(image(S.UPDATE_BEFORE, "_before"), image(S.UPDATE_AFTER, "_after")))
    )
    return both.select(F.explode(events).alias("e")).select("e._change_type", "e.row.*")


#: Buckets whose digests are compared; the list of the differing ones is at most this long.
DIGESTS = 4_096


def _digests(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    """For each bucket of keys the number of rows and two sums over hashes of whole rows, which no order of rows changes."""
    whole = rows.select(_bucket(key, buckets).alias("_bucket"), F.xxhash64(*rows.columns).alias("_h"), F.hash(*rows.columns).alias("_g"))
    return whole.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("_h").alias("h"), F.sum("_g").alias("g"))


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets))


def differing(old: DataFrame, new: DataFrame, key: str, buckets: int = DIGESTS) -> DataFrame:
    """The buckets (``_bucket``) that two snapshots do not hold alike."""
    before, after = _digests(old, key, buckets), _digests(new.select(old.columns), key, buckets)
    same = before.join(after, ["_bucket", "n", "h", "g"]).select("_bucket")
    every = before.select("_bucket").unionByName(after.select("_bucket")).distinct()
    return every.join(same, "_bucket", "left_anti")


def snapshot_changes_by_digest(old: DataFrame, new: DataFrame, key: str, buckets: int = DIGESTS) -> DataFrame:
    """``snapshot_changes`` of stored snapshots that are mostly equal.

    Both are read twice; rows of buckets with equal digests leave before the shuffle.
    Rows that differ in a bucket of equal digests (about 2^-96 for a pair) would be missed.
    """
    unlike = F.broadcast(differing(old, new, key, buckets))  # at most ``buckets`` numbers

    def of_unlike(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_bucket", _bucket(key, buckets)).join(unlike, "_bucket", "left_semi").drop("_bucket")

    return snapshot_changes(of_unlike(old), of_unlike(new.select(old.columns)), key)


def cascade_set_null(
    children: DataFrame, deleted_parents: DataFrame, key: str, child_id: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The update pairs child rows get when their parent is deleted and the reference is set to NULL.

    ``deleted_parents`` holds (key, _commit_timestamp) once per parent.
    """
    hit = spread_lookup(
        children.filter(F.col(key).isNotNull()), deleted_parents.select(key, "_commit_timestamp"), key, "inner",
        child_id, hot_rows,
    )
    images = F.array(
        F.struct(F.lit(S.UPDATE_BEFORE).alias("_change_type"), F.col(key).alias("_parent")),
        F.struct(F.lit(S.UPDATE_AFTER).alias("_change_type"), F.lit(None).cast("string").alias("_parent")),
    )
    rest = [c for c in children.columns if c != key]
    return hit.withColumn("_image", F.explode(images)).select(
        "_commit_timestamp", "_image._change_type", F.col("_image._parent").alias(key), *rest
    )
