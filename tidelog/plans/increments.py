"""The batch job: applies landed batches in time order, each once."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from tidelog import schemas as S
from tidelog.operators.skew import HOT_ROWS
from tidelog.plans import state
from tidelog.sources import ledger


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def apply_pending(
    spark: SparkSession,
    raw: str,
    lists: str,
    root: str,
    job: str = "silver",
    limit: int | None = None,
    hot_rows: int = HOT_ROWS,
    buckets: int = state.BUCKETS,
    now: Callable[[], datetime] = _utc_now,
) -> list[str]:
    """Apply what is landed in ``raw`` and listed in ``lists`` but not applied to the state in ``root``; returns the batches.

    Each batch is read from its own folder and makes one version of the state.  ``limit`` bounds
    how many batches a run applies.
    """
    waiting = ledger.pending(spark, lists, job)
    # one short row for each batch that waits
    names = [r[ledger.BATCH] for r in (waiting.limit(limit) if limit is not None else waiting).collect()]
    version = ledger.applied(spark, lists, job).count()
    for batch_id in names:
        rows = {entity: ledger.read_batch(spark, raw, lists, entity, batch_id) for entity in S.ENTITY_COLUMNS}
        state.apply_batch(rows, version, root, hot_rows, buckets)
        ledger.record_applied(spark, lists, job, batch_id, version, now())
        version += 1
    return names
