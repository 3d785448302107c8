"""Incremental jobs on Structured Streaming.

Progress lives in the checkpoint folder.  A micro-batch that is run again after a
failure overwrites its own output, so each batch counts once.  A backlog is taken in
batches of ``files_per_batch`` files if that is given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import schemas as S
from tidelog.operators.quality import write_documents
from tidelog.operators.skew import HOT_ROWS
from tidelog.plans import state
from tidelog.sources import bronze, feed


def change_stream(
    spark: SparkSession, source: str, archive: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """The elements of JSON change files as they arrive; consumed files can be moved to an archive folder."""
    reader = spark.readStream
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return feed.elements(reader.text(source))


def run_available(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process what has arrived since the checkpoint, then stop.  A failed batch raises."""
    query = (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def _parsed(told: DataFrame, path: str) -> DataFrame:
    """The elements of a batch, parsed once: written and read back."""
    judged = feed.read_as(told)
    judged.write.mode("overwrite").parquet(path)
    return told.sparkSession.read.schema(judged.schema).parquet(path)


def ingest_available(
    spark: SparkSession,
    source: str,
    raw_root: str,
    checkpoint: str,
    ingested_at: Column,
    archive: str | None = None,
    files_per_batch: int | None = None,
) -> None:
    """Land new change files as raw rows under ``raw_root/<entity>/batch=<n>/ingest_date=<d>``.

    Elements that are no events go to ``raw_root/refused/batch=<n>``; events of entities
    without a raw table are counted in ``raw_root/unknown/batch=<n>``.
    """

    def land(told: DataFrame, epoch: int) -> None:
        judged = _parsed(told, f"{raw_root}/parsed/batch={epoch}")
        write_documents(feed.refused_in(judged, ingested_at), f"{raw_root}/refused", epoch)
        batch = bronze.stamped(feed.events_in(judged), ingested_at, F.lit(f"stream-{epoch}"))
        bronze.unknown_entities(batch).write.mode("overwrite").parquet(f"{raw_root}/unknown/batch={epoch}")
        bronze.write_entities(batch, lambda entity: f"{raw_root}/{entity}/batch={epoch}", "overwrite")

    run_available(change_stream(spark, source, archive, files_per_batch), land, checkpoint)


def read_landed(spark: SparkSession, raw_root: str, entity: str, extra: list[str] | None = None) -> DataFrame:
    columns = S.landed_columns(entity) + (extra or []) + ["ingest_date"]
    schema = S.struct_of(columns).add("batch", T.IntegerType())
    return spark.read.schema(schema).parquet(f"{raw_root}/{entity}").drop("batch")


def read_unknown(spark: SparkSession, raw_root: str) -> DataFrame:
    """Events of entities without a raw table, counted by batch."""
    return spark.read.schema("entity_type string, row_count long, batch int").parquet(f"{raw_root}/unknown")


def apply_batch(batch: DataFrame, epoch: int, root: str, hot_rows: int = HOT_ROWS, buckets: int = state.BUCKETS) -> None:
    """One batch of a mixed feed on top of the state of the batch before it."""
    rows = {entity: bronze.entity_rows(batch, entity) for entity in S.ENTITY_COLUMNS}
    state.apply_batch(rows, epoch, root, hot_rows, buckets)


def apply_available(
    spark: SparkSession,
    source: str,
    root: str,
    checkpoint: str,
    hot_rows: int = HOT_ROWS,
    buckets: int = state.BUCKETS,
    files_per_batch: int | None = None,
) -> None:
    """Apply new change files to the state below ``root``; what is no event goes to ``root/refused/batch=<n>``."""

    def apply(told: DataFrame, epoch: int) -> None:
        judged = _parsed(told, f"{root}/parsed/batch={epoch}")
        write_documents(feed.refused_in(judged, F.lit(None).cast("timestamp_ntz")), f"{root}/refused", epoch)
        events = bronze.stamped(feed.events_in(judged), F.col("_commit_timestamp"), F.lit(f"stream-{epoch}"))
        apply_batch(events, epoch, root, hot_rows, buckets)

    run_available(change_stream(spark, source, files_per_batch=files_per_batch), apply, checkpoint)
