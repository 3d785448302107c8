"""The raw layer: stamped, conformed, partitioned by ingestion date."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import schemas as S
from tidelog.workspace import side_by_side


def stamped(events: DataFrame, ingested_at: Column, batch_id: Column) -> DataFrame:
    """Add ingestion time, batch id and ingestion date.  The time is passed in, so a rerun gives the same rows."""
    return events.withColumns(
        {
            "_bronze_ingested_at": ingested_at,
            "_bronze_batch_id": batch_id,
            "ingest_date": F.to_date(ingested_at),
        }
    )


def drift_columns(columns: list[str], entity: str) -> list[str]:
    """Columns an entity is not expected to have, sorted."""
    expected = set(S.landed_columns(entity)) | {"ingest_date"}
    return sorted(set(columns) - expected)


def conformed(rows: DataFrame, entity: str) -> DataFrame:
    """Expected columns first, then the drifted ones."""
    expected = [c for c in S.landed_columns(entity) if c in rows.columns]
    return rows.select(*expected, *drift_columns(rows.columns, entity))


def entity_rows(events: DataFrame, entity: str) -> DataFrame:
    """One entity of a mixed, stamped feed, without the other entities' own columns."""
    foreign = {c for e, cs in S.ENTITY_COLUMNS.items() if e != entity for c in cs} - set(S.ENTITY_COLUMNS[entity])
    return events.filter(F.col("entity_type") == entity).drop(*foreign)


def drift_report(events: DataFrame) -> DataFrame:
    """Unexpected columns per entity and how many rows fill them.

    Columns the feed declares are counted in one pass; undeclared ones, kept as a
    map, by their names.
    """
    found = _declared_drift(events.drop(S.EXTRA))
    if S.EXTRA not in events.columns:
        return found
    names = events.filter(F.col("entity_type").isin(*S.ENTITY_COLUMNS)).select(
        "entity_type", F.explode(F.map_keys(S.EXTRA)).alias("column_name")
    )
    return found.unionByName(names.groupBy("entity_type", "column_name").agg(F.count(F.lit(1)).alias("rows_filled")))


def _declared_drift(events: DataFrame) -> DataFrame:
    counts = events.groupBy("entity_type").agg(*[F.count(c).alias(c) for c in events.columns if c != "entity_type"])
    filled = counts.unpivot("entity_type", [c for c in counts.columns if c != "entity_type"], "column_name", "rows_filled")
    known = F.lit(False)
    for entity in S.ENTITY_COLUMNS:
        expected = [*S.landed_columns(entity), "ingest_date"]
        known = known | ((F.col("entity_type") == entity) & F.col("column_name").isin(expected))
    return filled.filter(F.col("entity_type").isin(*S.ENTITY_COLUMNS) & ~known & (F.col("rows_filled") > 0))


def write_partitioned(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Write by ingestion date.  The rebalance lets AQE merge small and split large dates."""
    rows.hint("rebalance", "ingest_date").write.mode(mode).partitionBy("ingest_date").parquet(path)


def filled_drift(events: DataFrame) -> dict[str, list[str]]:
    """Declared columns per entity that drifted and hold a value: at most columns x entities names."""
    found = _declared_drift(events.drop(S.EXTRA)).select("entity_type", "column_name").collect()
    return {e: sorted(r.column_name for r in found if r.entity_type == e) for e in S.ENTITY_COLUMNS}


def write_entities(
    events: DataFrame, path_of: Callable[[str], str], mode: str = "append", leave_out: tuple[str, ...] = ()
) -> dict[str, list[str]]:
    """Route a stamped feed to one folder per known entity; returns the columns of each.

    Each entity gets its own drifted columns only; undeclared columns stay a map.  The
    columns ``leave_out``, which the folder tells, are not written.  Other entities have
    no folder: ``unknown_entities`` counts them.  The feed is read for the drift and for
    each entity, so it is kept between (in memory or on executor disks; what is lost
    with an executor is parsed again).
    """
    events.persist()
    written = {}
    try:
        drift = filled_drift(events)
        extra = [c for c in events.columns if c == S.EXTRA]
        for entity in S.ENTITY_COLUMNS:
            written[entity] = [c for c in [*S.landed_columns(entity), *drift[entity], *extra] if c not in leave_out]

        def write(entity: str) -> None:
            write_partitioned(entity_rows(events, entity).select(*written[entity], "ingest_date"), path_of(entity), mode)

        side_by_side(events.sparkSession, *[partial(write, entity) for entity in written])
    finally:
        events.unpersist()
    return written


def unknown_entities(events: DataFrame) -> DataFrame:
    """How many events belong to entities that have no raw table."""
    others = events.filter(~F.col("entity_type").isin(*S.ENTITY_COLUMNS))
    return others.groupBy("entity_type").agg(F.count(F.lit(1)).alias("row_count"))


def read_raw(spark: SparkSession, path: str, entity: str, extra: list[str] | None = None) -> DataFrame:
    """Scan with the declared columns: no footer of any file has to be read for the schema."""
    columns = S.landed_columns(entity) + (extra or []) + ["ingest_date"]
    return spark.read.schema(S.struct_of(columns)).parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Scan files of differing columns; a missing column is NULL."""
    return spark.read.option("mergeSchema", True).parquet(path)


def replace_table(rows: DataFrame, path: str) -> None:
    """Full refresh."""
    rows.write.mode("overwrite").parquet(path)


def batch_ids(*tables: DataFrame) -> DataFrame:
    ids = [t.select("_bronze_batch_id") for t in tables]
    every = ids[0]
    for more in ids[1:]:
        every = every.unionByName(more)
    return every.distinct()


def pending_batches(batches: DataFrame, processed: DataFrame) -> DataFrame:
    return batches.join(processed, "_bronze_batch_id", "left_anti")


def _rank_among(column: str, cuts: list) -> Column:
    """How many of the ascending cuts are below the value, by halving: a comparison for each bit of the rank."""
    if not cuts:
        return F.lit(0)
    middle = len(cuts) // 2
    upper, lower = _rank_among(column, cuts[middle + 1 :]), _rank_among(column, cuts[:middle])
    return F.when(F.col(column) > F.lit(cuts[middle]), upper + middle + 1).otherwise(lower)


def interleaved(rows: DataFrame, columns: list[str], partitions: int, bits: int = 6, sampled: int = 10_000) -> DataFrame:
    """Range-partition by several columns at once, so that files are narrow in each of them.

    A value's rank among 2^bits quantiles of its column gives ``bits`` bits; those of all
    columns are interleaved, highest first, and files are ranges of the result.  The
    quantiles come from the ``sampled`` rows of lowest hash; NULL ranks lowest.
    """
    sample = rows.select(columns).orderBy(F.xxhash64(*columns)).limit(sampled).collect()
    place = F.lit(0).cast("bigint")
    for i, column in enumerate(columns):
        values = sorted(r[column] for r in sample if r[column] is not None)
        cuts = sorted({values[len(values) * k // (1 << bits)] for k in range(1, 1 << bits)}) if values else []
        rank = F.coalesce(_rank_among(column, cuts), F.lit(0))
        for bit in range(bits):
            shift = bit * len(columns) + len(columns) - 1 - i
            place = place + F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint"), shift)
    ranged = rows.withColumn("_place", place).repartitionByRange(partitions, "_place", *columns)
    return ranged.sortWithinPartitions("_place", *columns).drop("_place")


def clustered(rows: DataFrame, columns: list[str], partitions: int | None = None) -> DataFrame:
    """Range-partition and sort, so that file statistics let readers skip files.

    A value that fills several ranges is split by the columns after it.  Without a
    number, the session's shuffle partitions are used and AQE merges small ones.
    """
    ranges = [partitions, *columns] if partitions else columns
    return rows.repartitionByRange(*ranges).sortWithinPartitions(*columns)
