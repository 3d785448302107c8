"""Run and audit records."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import schemas as S
from tidelog.functions import columns as C


def audit_rows(
    counts: DataFrame, pipeline: str, layer: str, status: str, error: str, started: Column, ended: Column
) -> DataFrame:
    """Audit records for (target_table, records_processed, records_quarantined), types as declared."""
    rows = counts.withColumns(
        {
            "log_id": F.uuid(),
            "pipeline_name": F.lit(pipeline),
            "layer": F.lit(layer),
            "status": F.lit(status),
            "error_message": F.lit(error),
            "start_time": started,
            "end_time": ended,
        }
    ).withColumn("duration_seconds", C.seconds_between("start_time", "end_time"))
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in S.AUDIT_SCHEMA.fields])


def append_audit(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def append_event(
    spark: SparkSession, path: str, run_id: str, pipeline: str, kind: str, at: datetime, records: int | None = None,
    error: str | None = None,
) -> None:
    """Record that a run began (START) or how it ended (SUCCESS, FAILED).  A run that dies leaves its START only."""
    row = spark.createDataFrame([(run_id, pipeline, kind, at, records, error)], S.RUN_EVENT_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(path)


def run_status(events: DataFrame) -> DataFrame:
    """Start and finish events folded into one row per run; a run without a finish is RUNNING.

    Events are (run_id, pipeline_name, kind, at, records_processed, error_message).
    """
    start, finish = F.col("kind") == "START", F.col("kind") != "START"
    return (
        events.groupBy("run_id")
        .agg(
            F.max("pipeline_name").alias("pipeline_name"),
            F.min(F.when(start, F.col("at"))).alias("start_time"),
            F.max(F.when(finish, F.col("at"))).alias("end_time"),
            F.max_by("kind", F.when(finish, F.col("at"))).alias("finished_as"),
            F.max(F.when(finish, F.col("records_processed"))).alias("records"),
            F.max(F.when(finish, F.col("error_message"))).alias("error_message"),
        )
        .select(
            "run_id", "pipeline_name", "start_time", "end_time",
            C.seconds_between("start_time", "end_time").alias("duration_seconds"),
            F.coalesce("finished_as", F.lit("RUNNING")).alias("status"),
            F.coalesce("records", F.lit(0)).cast("long").alias("records_processed"),
            "error_message",
        )
    )


def recent_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    return runs.orderBy(F.desc("start_time"), "run_id").limit(n)


def failed(rows: DataFrame, tie_break: str, n: int = 5) -> DataFrame:
    """The latest failures of a run table or an audit table."""
    return rows.filter(F.col("status") == "FAILED").orderBy(F.desc("start_time"), tie_break).limit(n)


def alerts(runs: DataFrame) -> DataFrame:
    """What a failure notice says."""
    return runs.filter(F.col("status") == "FAILED").select(
        F.col("pipeline_name").alias("pipeline"), "run_id", F.col("start_time").alias("execution_time"),
        F.col("end_time").alias("failed_at"), F.col("error_message").alias("error"),
    )


def quality_by_status(audit: DataFrame, today: Column, days: int = 7) -> DataFrame:
    """Clean and quarantined totals of the last days, split by whether a run quarantined anything."""
    since = F.date_sub(today, days).cast("timestamp_ntz")
    bucket = F.when(F.col("records_quarantined") > 0, "Quarantined").otherwise("Clean")
    return (
        audit.filter(F.col("start_time") >= since)
        .groupBy(bucket.alias("record_status"))
        .agg(F.sum("records_processed").alias("total_clean"), F.sum("records_quarantined").alias("total_quarantined"))
    )


def duration_trend(audit: DataFrame) -> DataFrame:
    return (
        audit.filter(F.col("status") == "SUCCESS")
        .select("start_time", "pipeline_name", "layer", "duration_seconds")
        .orderBy(F.desc("start_time"))
    )
