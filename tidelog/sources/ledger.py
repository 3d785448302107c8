"""The lists of landed and of applied batches.

Raw rows of a batch lie in a folder of their own, ``<raw>/<entity>/_bronze_batch_id=<id>``.
Beside them the ledger keeps two small tables.  ``landed`` has a row for each
(batch, entity, ingestion date): number of rows, smallest and largest sequence, the
columns the entity had.  ``applied`` has a row for each batch a job has applied, and the
version of the job's state that it made.

What is pending is an anti-join of the two; no raw data is read for it.  A batch is
listed after its rows are written, and recorded as applied after the state is, each by
one write that replaces its own folder.  A job killed in between finds the batch pending
again, under the same version, and overwrites what it had written.  A state has one
writer at a time.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import schemas as S
from tidelog.sources import bronze
from tidelog.workspace import read_if_any

BATCH = "_bronze_batch_id"
_PLAIN = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def _folder(kind: str, name: str) -> str:
    """A partition folder; names other than plain ones would be read back changed."""
    if not _PLAIN.fullmatch(name):
        raise ValueError(f"{name!r} is no plain name")
    return f"{kind}={name}"


# --- landing ---------------------------------------------------------------------------------


def raw_schema(columns: list[str]) -> T.StructType:
    return S.struct_of([*columns, "ingest_date", BATCH])


def land(
    events: DataFrame, batch_id: str, landed_at: datetime, raw: str, ledger: str, ingested_at: Column | None = None
) -> None:
    """Write a batch of a feed to the raw tables and list it.  Landing a batch again replaces it.

    ``landed_at`` orders the batches; rows are stamped with it unless ``ingested_at`` is given.
    """
    spark, folder, at = events.sparkSession, _folder(BATCH, batch_id), F.lit(landed_at).cast("timestamp_ntz")
    stamped = bronze.stamped(events, at if ingested_at is None else ingested_at, F.lit(batch_id))
    written = bronze.write_entities(stamped, lambda entity: f"{raw}/{entity}/{folder}", "overwrite", (BATCH,))
    listed = None
    for entity, columns in written.items():
        rows = spark.read.schema(S.struct_of(["_row_sequence_id", "ingest_date"])).parquet(f"{raw}/{entity}/{folder}")
        found = rows.groupBy("ingest_date").agg(
            F.count(F.lit(1)).alias("row_count"), F.min("_row_sequence_id").alias("first_id"), F.max("_row_sequence_id").alias("last_id")
        ).withColumns({"entity_type": F.lit(entity), "columns": F.array(*[F.lit(c) for c in columns]), "landed_at": at})
        listed = found if listed is None else listed.unionByName(found)
    listed.select(S.LANDED_SCHEMA.names).coalesce(1).write.mode("overwrite").parquet(f"{ledger}/landed/{folder}")


def landed(spark: SparkSession, ledger: str) -> DataFrame:
    """A row for each (batch, entity, ingestion date)."""
    return read_if_any(spark, f"{ledger}/landed", T.StructType([*S.LANDED_SCHEMA.fields, T.StructField(BATCH, T.StringType())]))


def known_columns(spark: SparkSession, ledger: str, entity: str) -> list[str]:
    """All columns an entity has had, declared ones first, added ones in the order of their batches.

    The list comes from the ledger, so a scan over files of differing columns needs none of their footers.
    """
    rows = landed(spark, ledger).filter(F.col("entity_type") == entity).select(F.posexplode("columns").alias("place", "name"), "landed_at", BATCH)
    first = rows.groupBy("name").agg(F.min(F.struct("landed_at", BATCH, "place")).alias("first"))
    declared = S.landed_columns(entity)
    added = [r["name"] for r in first.orderBy("first").collect() if r["name"] not in declared]
    return [c for c in declared if c != BATCH] + [c for c in added if c != BATCH]


def schema_log(spark: SparkSession, ledger: str) -> DataFrame:
    """The batch in which each entity first had each column that is not declared."""
    rows = landed(spark, ledger).select("entity_type", F.explode("columns").alias("column_name"), "landed_at", BATCH)
    declared = F.lit(False)
    for entity in S.ENTITY_COLUMNS:
        declared = declared | ((F.col("entity_type") == entity) & F.col("column_name").isin(S.landed_columns(entity)))
    first = rows.filter(~declared).groupBy("entity_type", "column_name").agg(F.min(F.struct("landed_at", BATCH)).alias("first"))
    return first.select("entity_type", "column_name", F.col(f"first.{BATCH}").alias("since_batch"))


def read_raw(spark: SparkSession, raw: str, ledger: str, entity: str) -> DataFrame:
    """All raw rows of an entity with every column it has had."""
    columns = known_columns(spark, ledger, entity)
    return read_if_any(spark, f"{raw}/{entity}", raw_schema(columns)).select(*columns, BATCH, "ingest_date")


def read_batch(spark: SparkSession, raw: str, ledger: str, entity: str, batch_id: str) -> DataFrame:
    """The raw rows of one batch; no other folder is listed."""
    columns = known_columns(spark, ledger, entity)
    rows = read_if_any(spark, f"{raw}/{entity}/{_folder(BATCH, batch_id)}", S.struct_of([*columns, "ingest_date"]))
    return rows.withColumn(BATCH, F.lit(batch_id)).select(*columns, BATCH, "ingest_date")


def changes_after(spark: SparkSession, raw: str, ledger: str, entity: str, last_id: int) -> DataFrame:
    """The raw rows above a sequence number, from those (batch, date) folders only that can hold any.

    The folders come from the ranges in the ledger by a join that prunes partitions at run time.
    """
    reach = landed(spark, ledger).filter((F.col("entity_type") == entity) & (F.col("last_id") > last_id))
    rows = read_raw(spark, raw, ledger, entity).filter(F.col("_row_sequence_id") > last_id)
    return rows.join(F.broadcast(reach.select(BATCH, "ingest_date")), [BATCH, "ingest_date"], "left_semi")


# --- applying --------------------------------------------------------------------------------


def applied(spark: SparkSession, ledger: str, job: str) -> DataFrame:
    """The batches a job has applied, with the version each made."""
    return read_if_any(spark, f"{ledger}/applied/{_folder('job', job)}", S.APPLIED_SCHEMA)


def pending(spark: SparkSession, ledger: str, job: str) -> DataFrame:
    """Landed batches the job has not applied: time of landing, dates, rows and sequences, oldest first."""
    batches = landed(spark, ledger).groupBy(BATCH).agg(
        F.min("landed_at").alias("landed_at"), F.min("ingest_date").alias("first_date"), F.max("ingest_date").alias("last_date"),
        F.sum("row_count").alias("row_count"), F.min("first_id").alias("first_id"), F.max("last_id").alias("last_id"),
    )
    return bronze.pending_batches(batches, applied(spark, ledger, job).select(BATCH)).orderBy("landed_at", "first_id", BATCH)


def record_applied(spark: SparkSession, ledger: str, job: str, batch_id: str, version: int, at: datetime) -> None:
    """The batch counts as applied once this one row is written."""
    row = spark.createDataFrame([(batch_id, version, at)], S.APPLIED_SCHEMA)
    row.coalesce(1).write.mode("overwrite").parquet(f"{ledger}/applied/{_folder('job', job)}/{_folder(BATCH, batch_id)}")
