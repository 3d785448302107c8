"""Data tests as queries.  A failing row count of zero means the test passes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog import schemas as S
from tidelog.operators.skew import HOT_ROWS, spread_lookup

# Tests of single rows: table -> (column, test). UNIQUE and the relationship need a shuffle.
ROW_TESTS = {
    "stg_customers": [("customer_id", "not_null")],
    "stg_orders": [("order_id", "not_null")],
    "silver_customers": [("customer_sk", "not_null")],
    "silver_orders": [("order_id", "not_null"), ("order_amount", "non_negative")],
    "dim_customers": [("customer_sk", "not_null")],
    "fact_orders": [("order_id", "not_null"), ("customer_sk", "not_null"), ("order_status", "accepted_values")],
}
UNIQUE = {
    "silver_customers": ["customer_sk"],
    "silver_orders": ["order_id"],
    "dim_customers": ["customer_sk"],
    "fact_orders": ["order_id"],
}
_FAILS = {
    "not_null": lambda c: F.col(c).isNull(),
    "non_negative": lambda c: F.col(c) < 0,
    "accepted_values": lambda c: ~F.col(c).isin(S.ORDER_STATUSES),
}


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _result(table: str, column: str, kind: str, failures: Column) -> list[Column]:
    return [
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.lit(kind).alias("test_name"),
        failures.cast("long").alias("failures"),
    ]


def row_tests(tables: dict[str, DataFrame], kinds: set[str]) -> DataFrame:
    """Failing rows per test; all tests of a table are counted in one pass over it."""
    found = []
    for table, tests in ROW_TESTS.items():
        chosen = [(c, kind) for c, kind in tests if kind in kinds]
        if not chosen or table not in tables:
            continue
        counts = tables[table].agg(*[F.count_if(_FAILS[kind](c)).alias(f"{c}/{kind}") for c, kind in chosen])
        rows = counts.unpivot([], [F.col(f"`{n}`") for n in counts.columns], "test", "failures")
        found.append(
            rows.select(
                F.lit(table).alias("table_name"),
                F.split_part("test", F.lit("/"), F.lit(1)).alias("column_name"),
                F.split_part("test", F.lit("/"), F.lit(2)).alias("test_name"),
                "failures",
            )
        )
    return _union(found)


def not_null(tables: dict[str, DataFrame]) -> DataFrame:
    return row_tests(tables, {"not_null"})


def accepted_status(facts: DataFrame) -> DataFrame:
    return row_tests({"fact_orders": facts}, {"accepted_values"})


def unique(tables: dict[str, DataFrame]) -> DataFrame:
    """Values that occur more than once; NULL is not tested."""
    found = []
    for table, columns in UNIQUE.items():
        for c in columns:
            repeats = tables[table].filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
            found.append(repeats.agg(F.count_if(F.col("n") > 1).alias("f")).select(_result(table, c, "unique", F.col("f"))))
    return _union(found)


def _fact_keys(facts: DataFrame) -> DataFrame:
    return facts.filter(F.col("customer_sk").isNotNull()).groupBy("customer_sk").agg(F.count(F.lit(1)).alias("n"))


def _keys_without_parent(facts: DataFrame, dimension: DataFrame) -> DataFrame:
    """Fact keys the dimension does not have; facts are counted per key before the join."""
    parents = dimension.select("customer_sk").filter(F.col("customer_sk").isNotNull())
    return _fact_keys(facts).join(parents, "customer_sk", "left_anti")


def relationship(facts: DataFrame, dimension: DataFrame) -> DataFrame:
    missing = _keys_without_parent(facts, dimension).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("f"))
    return missing.select(_result("fact_orders", "customer_sk", "relationships", F.col("f")))


def negative_amounts(orders: DataFrame) -> DataFrame:
    """The offending rows."""
    return orders.filter(F.col("order_amount") < 0).select("order_id", "order_amount")


#: Columns whose values are grouped for the summary, by table; values of one column are grouped together over its tables.
_KEYS = {
    "silver_customers": ["customer_sk"], "silver_orders": ["order_id"], "dim_customers": ["customer_sk"],
    "fact_orders": ["order_id", "customer_sk"],
}


def _grouped_tests(tables: dict[str, DataFrame]) -> DataFrame:
    """One row: failures of the row tests, of uniqueness and of the relationship, for tables with keys.

    Each table is read once, each key shuffled once: a row gives its keys, and its own
    failures with the first of them, to a count by column and value.
    """
    tests = {t: [(c, kind) for c, kind in ROW_TESTS[t] if (c, kind) != (c, "not_null") or c not in _KEYS[t]] for t in _KEYS}
    fails = [f"{t}/{c}/{kind}" for t in _KEYS for c, kind in tests[t]]
    rows = []
    for table, columns in _KEYS.items():
        own = {f"{table}/{c}/{kind}": _FAILS[kind](c).cast("int") for c, kind in tests[table]}
        keys = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), F.lit(i == 0).alias("first")) for i, c in enumerate(columns)])
        told = tables[table].select(*[v.alias(n) for n, v in own.items()], F.explode(keys).alias("key"))
        shown = [F.when(F.col("key.first"), F.col(f"`{n}`")).alias(n) if n in own else F.lit(None).cast("int").alias(n) for n in fails]
        rows.append(told.select(F.lit(table).alias("table"), "key.column", "key.value", *shown))
    grouped = _union(rows).groupBy("column", "value").agg(
        *[F.count_if(F.col("table") == t).alias(t) for t in _KEYS], *[F.sum(f"`{n}`").alias(n) for n in fails]
    )
    empty = F.col("value").isNull()
    found = {n: F.sum(f"`{n}`") for n in fails}
    for table, columns in _KEYS.items():
        for c in columns:
            is_column = F.col("column") == c
            found[f"{table}/{c}/not_null"] = F.sum(F.when(is_column & empty, F.col(table)))
            if c in UNIQUE[table]:
                found[f"{table}/{c}/unique"] = F.count_if(is_column & ~empty & (F.col(table) > 1))
    lost = (F.col("column") == "customer_sk") & ~empty & (F.col("dim_customers") == 0)
    found["fact_orders/customer_sk/relationships"] = F.sum(F.when(lost, F.col("fact_orders")))
    return grouped.agg(*[F.coalesce(v, F.lit(0)).cast("long").alias(n) for n, v in found.items()])


def summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Every data test with its failures; each table is read once."""
    counts = _grouped_tests(tables)
    rows = counts.unpivot([], [F.col(f"`{n}`") for n in counts.columns], "test", "failures")
    part = lambda i: F.split_part("test", F.lit("/"), F.lit(i))
    grouped = rows.select(part(1).alias("table_name"), part(2).alias("column_name"), part(3).alias("test_name"), "failures")
    staged = row_tests({t: f for t, f in tables.items() if t not in _KEYS}, set(_FAILS))
    return grouped.unionByName(staged).withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def orphaned_facts(facts: DataFrame, dimension: DataFrame) -> DataFrame:
    """Facts whose key is NOT IN the dimension.

    As in SQL, one NULL key in the dimension makes the predicate unknown for every
    fact.  Counting per key first and anti-joining on non-NULL keys keeps this a
    shuffled hash or sort-merge join; a literal NOT IN would broadcast the dimension.
    """
    holes = dimension.agg(F.count_if(F.col("customer_sk").isNull())).scalar()
    missing = F.coalesce(F.sum("n"), F.lit(0))
    return _keys_without_parent(facts, dimension).agg(missing.alias("missing")).select(
        F.when(holes > 0, F.lit(0)).otherwise(F.col("missing")).cast("long").alias("orphaned_count")
    )


def _versions_of_changed(dimension: DataFrame, hot_rows: int) -> DataFrame:
    known = dimension.filter(F.col("customer_id") != "unknown")
    several = known.groupBy("customer_id").agg(F.count(F.lit(1)).alias("versions")).filter("versions > 1")
    return spread_lookup(known, several, "customer_id", "inner", "customer_sk", hot_rows)


def multi_version_customers(dimension: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All versions, in time order, of the customers that have more than one."""
    return (
        _versions_of_changed(dimension, hot_rows)
        .select("customer_id", "versions", "customer_sk", "email", "state", "valid_from", "valid_to")
        .orderBy("customer_id", "valid_from", "customer_sk")
    )


def multi_version_orders(facts: DataFrame, dimension: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Facts of the customers that have more than one version."""
    keys = _versions_of_changed(dimension, hot_rows).select("customer_id", "customer_sk")
    resolved = facts.filter(F.col("customer_sk") != S.UNKNOWN_KEY)
    return spread_lookup(resolved, keys, "customer_sk", "inner", "order_id", hot_rows).select(
        "customer_id", "order_id", "customer_sk", "order_amount", "created_at"
    )
