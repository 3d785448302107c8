"""Hot keys: cutting keys into slices must not change any result.

A threshold of a few rows makes nearly every key hot, the NULL key included.
"""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from scenarios.compare import difference
from scenarios.feed import CUT, derive_customers, ntz
from scenarios.queries import _delivered_late, _order_snapshot
from tidelog.functions import columns as C
from tidelog.operators import asof, capture, history, merge, skew
from tidelog.plans import checks, gold

HOT = [3, 40]


def _shown(frame):
    return frame.withColumn("valid_to", C.instant_text("valid_to")) if "valid_to" in frame.columns else frame


@pytest.mark.parametrize("hot", HOT)
def test_derived_feed(hot, lake, rows_of):
    columns = lake.raw_customers.columns
    assert rows_of(derive_customers(lake.source("events"), hot), columns) == rows_of(lake.raw_customers, columns)


@pytest.mark.parametrize("hot", HOT)
def test_history(hot, lake, duck):
    got = history.customer_history(lake.stg_customers, hot_rows=hot)
    assert difference(_shown(got), duck, entry.oracle_sql()["silver_customers"]) == ""


@pytest.mark.parametrize("hot", HOT)
def test_point_in_time_join(hot, lake, duck):
    got = gold.order_facts(lake.silver_orders, lake.dim_customers, hot)
    assert difference(got, duck, entry.oracle_sql()["fact_orders"]) == ""


@pytest.mark.parametrize("hot", HOT)
def test_merge_in_two_batches(hot, spark, lake, duck):
    raw = lake.raw_customers
    first, second = (raw.filter(f"ingest_date {op} date'{CUT}'") for op in ("<", ">="))
    known = merge.merge_history(merge.empty_history(raw), first, hot)
    got = merge.merge_history(known, second, hot)
    assert difference(_shown(got), duck, entry.oracle_sql()["scd2_merge_batch"]) == ""


@pytest.mark.parametrize("hot", HOT)
def test_late_changes(hot, lake, duck):
    raw = lake.raw_customers
    punctual = raw.filter(~_delivered_late())
    known = merge.merge_history(merge.empty_history(raw), punctual, hot)
    got = merge.late_changes(known, raw.filter(_delivered_late()), hot)
    assert difference(got, duck, entry.oracle_sql()["scd2_late_events"]) == ""


@pytest.mark.parametrize("hot", HOT)
def test_commit_time_join(hot, lake, duck, spark, sf_dir):
    from scenarios.queries import _split
    from tidelog.operators import latest

    known = merge.first_load(_split(lake, "customers")[0], hot)
    orders = latest.latest_per_key(_split(lake, "orders")[0], "order_id", ["_commit_timestamp", "_row_sequence_id"])
    got = gold.order_facts_by_commit(orders, known, hot)
    assert difference(got, duck, entry.oracle_sql()["fact_orders_commit_time"]) == ""


@pytest.mark.parametrize("hot", [3])
def test_salted_lookups(hot, lake, duck):
    deletes = lake.raw_customers.filter(
        (F.col("_change_type") == "DELETE") & F.col("customer_id").isNotNull() & (F.col("_commit_timestamp") >= ntz(CUT))
    ).groupBy("customer_id").agg(F.min("_commit_timestamp").alias("_commit_timestamp"))
    got = capture.cascade_set_null(_order_snapshot(lake, CUT), deletes, "customer_id", "order_id", hot)
    assert difference(got, duck, entry.oracle_sql()["cdc_cascade_set_null"]) == ""
    for name, call in {
        "multi_version_customers": lambda: checks.multi_version_customers(lake.dim_customers, hot),
        "multi_version_orders": lambda: checks.multi_version_orders(lake.fact_orders, lake.dim_customers, hot),
    }.items():
        assert difference(_shown(call()), duck, entry.oracle_sql()[name]) == ""


def test_left_lookup_keeps_null_keys(spark, rows_of):
    left = spark.createDataFrame([(None, i) for i in range(20)] + [("a", i) for i in range(20, 40)], "k string, id int")
    right = spark.createDataFrame([("a", "A"), ("b", "B")], "k string, v string")
    got = rows_of(skew.spread_lookup(left, right, "k", "left", "id", 3), ["k", "id", "v"])
    assert len(got) == 40
    assert all(v == ("A" if k == "a" else None) for k, _, v in got)


def test_hot_key_leaves_one_task(spark):
    """A key with a third of the rows is cut into slices of about the threshold."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("k"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 60)).alias("at"),
    )
    sizes = skew.mark_slices(rows, "k", "at", hot_rows=500).groupBy("k", "_slice").count()
    largest = sizes.agg(F.max("count")).first()[0]
    assert largest <= 500
    assert 20 <= sizes.filter("k = 'hot'").count() <= 22
    assert sizes.filter("k != 'hot' and _slice != 0").count() == 0


def test_bursts_are_cut_as_finely_as_they_are_dense(spark):
    """Five years of one key with nine tenths of its rows in one hour."""
    rows = spark.range(20_000).select(
        F.lit("hot").alias("k"),
        F.expr("timestamp_ntz'2020-01-01' + if(id % 10 = 0, make_dt_interval(0, id * 2), make_dt_interval(0, 0, 0, id * 0.18))").alias("at"),
    )
    sizes = skew.mark_slices(rows, "k", "at", hot_rows=500).groupBy("_slice").count()
    assert sizes.agg(F.max("count")).first()[0] <= 700


def test_open_versions_do_not_widen_slices(spark):
    """The closed join cuts on facts and starts of versions, not on an end in year 9999."""
    facts = spark.range(5_000).selectExpr("'a' as k", "id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id) as at")
    versions = spark.sql("select 'a' as k, timestamp_ntz'2023-01-01' as valid_from, timestamp_ntz'9999-12-31' as valid_to, 'v' as v")
    got = asof.asof_versions(facts, versions, "k", "at", ["v"], hot_rows=100, closed=True)
    assert got.filter("v = 'v'").count() == got.count() == 5_000
    widths = skew.mark_slices(facts.selectExpr("k", "at"), "k", "at", 100).groupBy("_slice").count().agg(F.max("count")).first()[0]
    assert widths <= 120


@pytest.mark.parametrize("limit", [0, 3])
def test_hot_keys_beyond_the_broadcast_limit(limit, monkeypatch, spark, rows_of):
    """Every key above the threshold is cut, however many there are, and the result is the same."""
    rows = spark.range(200).select(
        (F.col("id") % 10).cast("string").alias("k"), F.col("id").alias("seq"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 5)).alias("at"),
    )
    plain = rows_of(skew.with_neighbour(rows, "k", ["at", "seq"], ["seq"]), ["k", "seq", "next_seq"])
    monkeypatch.setattr(skew, "BROADCAST_KEYS", limit)
    marked = skew.mark_slices(rows, "k", "at", hot_rows=4)
    assert marked.filter("_hot_n is not null").select("k").distinct().count() == 10
    cut = rows_of(skew.with_neighbour(rows, "k", ["at", "seq"], ["seq"], hot_rows=4), ["k", "seq", "next_seq"])
    assert cut == plain


def test_keys_with_all_rows_at_one_instant_are_found(spark):
    rows = spark.range(4_000).selectExpr("cast(id % 20 as string) as k", "timestamp_ntz'2024-01-01' as at")
    assert skew.hot_keys(rows, "k", 100).n == 20


def _half_at_one_instant(spark, n):
    """Rows of one key, half of them at one instant, and of some small keys."""
    return spark.range(n).selectExpr(
        "if(id % 50 = 0, concat('k', id % 7), 'hot') as k", "id as seq",
        "timestamp_ntz'2024-01-01' + if(id % 2 = 0, make_dt_interval(1), make_dt_interval(0, 0, 0, id * 0.5)) as at",
    )


def test_an_instant_is_cut_and_slices_are_not_bounded_in_number(spark):
    """5,000 times the threshold, half of it at one instant: no slice is above the threshold, and order is kept."""
    marked = skew.mark_slices(_half_at_one_instant(spark, 51_000), "k", ["at", "seq"], hot_rows=10)
    sizes = marked.groupBy("k", "_slice").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("at", "seq")).alias("a"), F.max(F.struct("at", "seq")).alias("z"))
    hot = sizes.filter("k = 'hot'").orderBy("_slice").collect()
    assert len(hot) >= 4_998 and max(r.n for r in hot) <= 10
    assert all(x.z < y.a for x, y in zip(hot, hot[1:]))
    assert marked.count() == 51_000


def test_neighbours_across_a_cut_instant(spark, rows_of):
    rows = _half_at_one_instant(spark, 3_000)
    columns = ["k", "seq", "next_seq"]
    plain = rows_of(skew.with_neighbour(rows, "k", ["at", "seq"], ["seq"]), columns)
    assert rows_of(skew.with_neighbour(rows, "k", ["at", "seq"], ["seq"], hot_rows=40), columns) == plain


def test_repeated_rows_are_cut(spark):
    rows = spark.range(4_000).selectExpr("'hot' as k", "1 as seq", "timestamp_ntz'2024-01-01' as at")
    sizes = skew.mark_slices(rows, "k", ["at", "seq"], hot_rows=100).groupBy("_slice").count()
    assert sizes.agg(F.max("count")).first()[0] == 100 and sizes.count() == 40


@pytest.mark.parametrize("closed", [False, True])
def test_point_in_time_join_with_half_the_facts_at_one_instant(closed, spark, rows_of):
    """Facts of an instant in many slices see the version in force and every version that ends there."""
    facts = _half_at_one_instant(spark, 3_000)
    versions = spark.createDataFrame(
        [("hot", "2024-01-01 00:00:00", "2024-01-01 00:10:00", "v1"), ("hot", "2024-01-01 00:10:00", "2024-01-02 00:00:00", "v2"),
         ("hot", "2024-01-02 00:00:00", "2024-01-02 00:00:00", "v3"), ("hot", "2024-01-02 00:00:00", "9999-12-31 00:00:00", "v4"),
         ("k1", "2024-01-01 12:00:00", "2024-01-02 00:00:00", "w1"), ("never", "2024-01-01 00:00:00", "2024-01-02 00:00:00", "x")],
        "k string, a string, z string, v string",
    ).selectExpr("k", "cast(a as timestamp_ntz) as valid_from", "cast(z as timestamp_ntz) as valid_to", "v")
    want = rows_of(asof.asof_versions(facts, versions, "k", "at", ["v"], closed=closed), ["k", "seq", "v"])
    got = rows_of(asof.asof_versions(facts, versions, "k", "at", ["v"], hot_rows=25, closed=closed), ["k", "seq", "v"])
    assert got == want
    at_cut = [v for k, seq, v in got if k == "hot" and seq == 2]
    assert at_cut == (["v2", "v3", "v4"] if closed else ["v4"])


def test_batch_order_across_a_cut_instant(spark, rows_of):
    """Writes and deletes of one instant, cut in slices of a few rows, are ruled as in one window."""
    from tests.test_merge import SCHEMA, event

    rows = [event(i, ("INSERT", "UPDATE_AFTER", "DELETE", "UPDATE_AFTER")[i * 7 % 4], 5 if i % 3 else 5 + i // 30, "k", "NY") for i in range(10, 150)]
    known = merge.apply_changes(merge.empty_history(spark.range(0)), spark.createDataFrame([event(1, "INSERT", 4, "k"), event(2, "INSERT", 5, "b")], SCHEMA))
    batch = spark.createDataFrame(rows + [event(200 + i, "UPDATE_AFTER", i, "b") for i in range(9)], SCHEMA)
    for hot in (2, 7, 50):
        assert rows_of(merge.merge_history(known, batch, hot)) == rows_of(merge.merge_history(known, batch))
        assert rows_of(merge.late_changes(known, batch, hot)) == rows_of(merge.late_changes(known, batch))
