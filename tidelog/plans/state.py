"""What batches have made of the feed: customer history and last orders, in versions.

    history/v=<n>/is_current=1/bucket=<b>   open versions of the buckets that batch n touched
    history/v=<n>/is_current=0/bucket=-1    versions that batch n closed
    orders/v=<n>                            the last change of each order in batch n
    orders-base/v=<n>                       all orders after batch n, every COMPACT_EVERY versions
    late/v=<n>, quarantine/batch=<n>        customer events that came too late, rows with a blank key or no amount
    manifest/v=<n>                          where state n lies: the version of each bucket's open versions (-1: none), the base of the orders

A customer's open version lies in the bucket of its id's hash.  A batch reads and writes
the buckets its customers fall in and no others: it costs its own events and the open
versions beside them, not the open versions of all customers.  Closed versions are
written once.  The manifest is written last, so an earlier state can always be read, and
a batch that is applied again replaces its own folders and nothing else.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import schemas as S
from tidelog.functions import columns as C
from tidelog.operators.latest import latest_per_key
from tidelog.operators.merge import empty_history, late_of, ruled_changes, versions_of
from tidelog.operators.quality import key_quarantine, keyed_rows, write_documents
from tidelog.operators.skew import HOT_ROWS
from tidelog.workspace import read_if_any, side_by_side

BUCKETS, COMPACT_EVERY = 256, 16

_MANIFEST = "buckets array<int>, orders_base int"
_LATE = "_row_sequence_id long, customer_id string, _commit_timestamp timestamp_ntz, late_reason string, _bronze_batch_id string"
_ORDER_COLUMNS = ["order_id", "customer_id", "order_amount", "order_status", "created_at", "updated_at", "_bronze_batch_id"]


def _path(root: str, table: str, version: int) -> str:
    return f"{root}/{table}/v={version}"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _history_schema(spark: SparkSession) -> T.StructType:
    return T.StructType(empty_history(spark.range(0)).schema.fields)


def _manifest(spark: SparkSession, root: str, version: int, buckets: int) -> tuple[list[int], int]:
    """The version of each bucket and of the base of the orders; nothing yet before version 0."""
    if version < 0:
        return [-1] * buckets, -1
    row = spark.read.schema(_MANIFEST).parquet(_path(root, "manifest", version)).first()
    return list(row.buckets), row.orders_base


def _open_versions(spark: SparkSession, root: str, versions: list[int], wanted: set[int]) -> DataFrame:
    """The open versions of the wanted buckets; only folders that hold them are listed or read."""
    holders = defaultdict(list)
    for bucket in wanted:
        if versions[bucket] >= 0:
            holders[versions[bucket]].append(bucket)
    if not holders:
        return empty_history(spark.range(0))
    schema = _history_schema(spark).add("bucket", T.IntegerType())
    parts = [
        spark.read.schema(schema).option("basePath", _path(root, "history", v)).parquet(*[f"{_path(root, 'history', v)}/is_current=1/bucket={b}" for b in found])
        for v, found in holders.items()
    ]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.drop("bucket")


def apply_batch(rows: dict[str, DataFrame], version: int, root: str, hot_rows: int = HOT_ROWS, buckets: int = BUCKETS) -> None:
    """Apply one batch, the raw rows of each entity, to the state of the version before."""
    spark = rows["customers"].sparkSession
    known, base = _manifest(spark, root, version - 1, buckets)
    if len(known) != buckets:
        raise ValueError(f"the state has {len(known)} buckets, not {buckets}")
    customers, orders = (keyed_rows(rows[entity], entity) for entity in ("customers", "orders"))
    told: dict[str, list[int] | int] = {}

    def refuse() -> None:
        bad = [key_quarantine(r, entity, F.col("_bronze_ingested_at")) for entity, r in rows.items()]
        write_documents(bad[0].unionByName(bad[1]), f"{root}/quarantine", version)

    def merge_customers() -> None:
        told["places"] = _apply_customers(customers, known, version, root, hot_rows)

    def keep_orders() -> None:
        told["base"] = _apply_orders(orders, base, version, root)

    side_by_side(spark, refuse, merge_customers, keep_orders)
    manifest = spark.createDataFrame([(told["places"], told["base"])], _MANIFEST)
    manifest.coalesce(1).write.mode("overwrite").parquet(_path(root, "manifest", version))


def _apply_customers(customers: DataFrame, known: list[int], version: int, root: str, hot_rows: int) -> list[int]:
    """Write the versions and late events of a batch; returns where each bucket's open versions lie now."""
    spark, buckets = customers.sparkSession, len(known)
    # at most one number for each bucket
    touched = {r[0] for r in customers.select(bucket_of(C.cleaned("customer_id"), buckets)).distinct().collect()}
    ruled = ruled_changes(_open_versions(spark, root, known, touched), customers, hot_rows)
    ruled_path = _path(root, "ruled", version)
    ruled.write.mode("overwrite").parquet(ruled_path)
    ruled = spark.read.schema(ruled.schema).parquet(ruled_path)
    bucket = F.when(F.col("is_current") == 1, bucket_of(F.col("customer_id"), buckets)).otherwise(-1)
    versions = versions_of(ruled).withColumn("bucket", bucket).hint("rebalance", "is_current", "bucket")
    side_by_side(
        spark,
        lambda: late_of(ruled).write.mode("overwrite").parquet(_path(root, "late", version)),
        lambda: versions.write.mode("overwrite").partitionBy("is_current", "bucket").parquet(_path(root, "history", version)),
    )
    written = spark.read.schema(_history_schema(spark).add("bucket", T.IntegerType())).parquet(_path(root, "history", version))
    filled = {r[0] for r in written.filter("is_current = 1").select("bucket").distinct().collect()}
    return [(version if b in filled else -1) if b in touched else v for b, v in enumerate(known)]


def _apply_orders(orders: DataFrame, base: int, version: int, root: str) -> int:
    """Write the last change of each order of a batch; returns the version of the base, a new one every COMPACT_EVERY versions."""
    last = latest_per_key(orders, "order_id", ["_commit_timestamp", "_row_sequence_id"])
    last.select(S.landed_columns("orders")).write.mode("overwrite").parquet(_path(root, "orders", version))
    if version % COMPACT_EVERY != COMPACT_EVERY - 1:
        return base
    _orders(orders.sparkSession, root, base, version).write.mode("overwrite").parquet(_path(root, "orders-base", version))
    return version


def read_history(spark: SparkSession, root: str, version: int) -> DataFrame:
    """History after a version: everything closed so far and what is open now."""
    places, _ = _manifest(spark, root, version, 0)
    schema = _history_schema(spark).add("v", T.IntegerType()).add("bucket", T.IntegerType())
    rows = read_if_any(spark, f"{root}/history/v=*/is_current=0", schema, f"{root}/history")
    closed = rows.filter(F.col("v") <= version).drop("v", "bucket")
    return closed.unionByName(_open_versions(spark, root, places, set(range(len(places)))))


def changed_orders(spark: SparkSession, root: str, version: int) -> DataFrame:
    """The orders that the batch of a version changed or deleted."""
    schema = S.struct_of(S.landed_columns("orders"))
    return spark.read.schema(schema).parquet(_path(root, "orders", version)).select("order_id")


def changed_versions(spark: SparkSession, root: str, version: int) -> DataFrame:
    """The customers whose history the batch of a version changed, and ``since`` when.

    That is the start of the first version it opened, the end it gave to the one open
    before it, or the start of the one it flagged as deleted, which leaves the dimension.
    """
    rows = spark.read.schema(_history_schema(spark)).parquet(_path(root, "history", version))
    ended = F.expr("case when is_deleted = 1 then valid_from when is_current = 0 then valid_to end")
    # versions open before the batch lie in the folder as well if their bucket was touched
    before = _open_versions(spark, root, *_held_before(spark, root, version)).select("customer_id", "valid_from", F.lit(True).alias("_known"))
    told = rows.join(before, ["customer_id", "valid_from"], "left").withColumn("_begun", F.when(F.col("_known").isNull(), F.col("valid_from")))
    since = told.groupBy("customer_id").agg(F.least(F.min("_begun"), F.min(ended)).alias("since"))
    return since.filter("since is not null")


def _held_before(spark: SparkSession, root: str, version: int) -> tuple[list[int], set[int]]:
    """Where the buckets that a version touched lay before it."""
    now, _ = _manifest(spark, root, version, 0)
    before, _ = _manifest(spark, root, version - 1, len(now))
    return before, {b for b, v in enumerate(before) if v != now[b]}


def read_late(spark: SparkSession, root: str, version: int) -> DataFrame:
    """Late customer events of all batches up to a version."""
    return spark.read.schema(f"{_LATE}, v int").parquet(f"{root}/late").filter(F.col("v") <= version).drop("v")


def read_orders(spark: SparkSession, root: str, version: int) -> DataFrame:
    """Orders after a version: the newest change of each order, deletes removed."""
    return _orders(spark, root, _manifest(spark, root, version, 0)[1], version)


def _orders(spark: SparkSession, root: str, base: int, version: int) -> DataFrame:
    """The base and the last changes of each order in the batches after it; a change in a later batch is newer."""
    schema = S.struct_of(S.landed_columns("orders")).add("v", T.IntegerType())
    changes = spark.read.schema(schema).parquet(f"{root}/orders").filter((F.col("v") > base) & (F.col("v") <= version))
    if base >= 0:
        known = spark.read.schema(S.struct_of(_ORDER_COLUMNS)).parquet(_path(root, "orders-base", base))
        changes = changes.unionByName(known.withColumn("v", F.lit(base)), allowMissingColumns=True)
    last = latest_per_key(changes, "order_id", ["v", "_commit_timestamp", "_row_sequence_id"])
    return last.filter(F.coalesce("_change_type", F.lit("")) != S.DELETE).select(_ORDER_COLUMNS)
