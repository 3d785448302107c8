"""Applying a batch of changes to stored tables, as functions of two frames.

Parquet tables have no row-level MERGE, so each operator returns the rows of the
new table; the caller writes them to a new folder.  For dimension history only
the *open* versions take part: closed versions never change and stay where they
are, so the cost follows the batch and the open rows, not the length of history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog import schemas as S
from tidelog.functions import columns as C
from tidelog.operators.history import HISTORY_COLUMNS
from tidelog.operators.latest import latest_per_key
from tidelog.operators.skew import HOT_ROWS, border_rows, hot_keys, kept, mark_slices, with_neighbour

_OPEN, _WRITE, _DELETE = 0, 1, 2


def _batch_lane(batch: DataFrame) -> DataFrame:
    """Events that can change history: no before-images, no blank keys, unknown kinds ignored."""
    kinds = {S.INSERT: _WRITE, S.UPDATE_AFTER: _WRITE, S.DELETE: _DELETE}
    kind = "case _change_type " + " ".join(f"when '{k}' then {v}" for k, v in kinds.items()) + " end"
    text = ["first_name", "last_name", "email"]
    return (
        batch.withColumn("customer_id", C.cleaned("customer_id"))
        .filter(f"customer_id != '' and _change_type in ({', '.join(repr(k) for k in kinds)})")
        .select(
            "customer_id", C.digest_key("customer_id", "_commit_timestamp").alias("customer_sk"),
            *[C.cleaned(c).alias(c) for c in text], F.upper(C.cleaned("state")).alias("state"), "_bronze_batch_id",
            F.expr("_commit_timestamp as _at"), F.expr("_row_sequence_id as _seq"), F.expr(f"{kind} as _kind"),
            F.expr("1 as _rank"),
        )
    )


def _open_lane(history: DataFrame) -> DataFrame:
    """The open version of each key; its rank puts it before every event, however late its start."""
    return history.filter("is_current = 1").selectExpr(
        "customer_id", "customer_sk", "first_name", "last_name", "email", "state", "_bronze_batch_id",
        "valid_from as _at", "-1L as _seq", f"{_OPEN} as _kind", "0 as _rank",
    )


_ORDER = ["_rank", "_at", "_seq"]
_IN_ORDER = f"partition by customer_id, _slice order by {', '.join(_ORDER)}"

# why an event comes before the open version of its key, NULL where it does not
_TOO_OLD = (
    f"case when _kind = {_WRITE} and _at <= _open_from then 'NOT_AFTER_OPEN_VERSION'"
    f" when _kind = {_DELETE} and _at < _open_from then 'BEFORE_OPEN_VERSION' end"
)
_REPEATED = f"if(_kind = {_WRITE} and _before_kind = {_WRITE} and _before_at = _at, 'SAME_INSTANT', null)"


def _in_context(rows: DataFrame, events: DataFrame, hot_rows: int) -> tuple[DataFrame, bool]:
    """Rows of each key in order with the start of its open version, and kind and instant of the row before; whether a key is hot.

    An open version comes before the events of its key.
    """
    found = hot_keys(events, "customer_id", hot_rows)
    marked = mark_slices(rows, "customer_id", _ORDER, hot_rows, hot=found).withColumn(
        "_open_from", F.expr(f"if(_kind = {_OPEN}, _at, null)")
    )
    # Border rows of hot keys, before every slice: the start of the open version, which lies in the
    # first slice, and kind and instant of the last row of the slice before.
    tail = f"struct({', '.join(_ORDER)}, _kind)"
    borders = (
        marked.filter("_hot_n is not null").groupBy("customer_id", "_slice")
        .agg(F.expr(f"max({tail}) as _tail"), F.max("_open_from").alias("_open_from"))
        .selectExpr(
            "customer_id", "_slice", "lag(_tail) over (partition by customer_id order by _slice) as _tail",
            "max(_open_from) over (partition by customer_id order by _slice) as _open_from",
        ).filter("_tail is not null")
        .selectExpr(
            "customer_id", "_slice", "_open_from", "_tail._kind as _tail_kind", "-1 as _rank", "_tail._at as _at", "_tail._seq as _seq"
        )
    )
    both = marked.unionByName(borders, allowMissingColumns=True)
    placed = both.withColumns(
        {
            "_open_from": F.expr(f"max(_open_from) over ({_IN_ORDER} rows unbounded preceding)"),
            "_before_kind": F.expr(f"lag(coalesce(_kind, _tail_kind)) over ({_IN_ORDER})"),
            "_before_at": F.expr(f"lag(_at) over ({_IN_ORDER})"),
        }
    ).filter("_kind is not null")
    return placed.drop("_tail_kind"), found.n > 0


def _with_end(timely: DataFrame, carry: list[str]) -> DataFrame:
    """``_end``, and ``carry`` columns under ``_end``, of the next row of the key; border rows are left out."""
    ends = border_rows(timely, "customer_id", [*_ORDER, *carry], [], "next").withColumn("_border", F.lit(True))
    both = timely.drop("_hot_n").withColumn("_border", F.lit(False)).unionByName(ends, allowMissingColumns=True)
    taken = {f"_end{c}": F.expr(f"lead({c}) over ({_IN_ORDER})") for c in carry}
    return both.withColumns({"_end": F.expr(f"lead(_at) over ({_IN_ORDER})"), **taken}).filter("not _border")


def ruled_changes(history: DataFrame, batch: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Open versions and events of each key in order, with ``_late`` set on events that come too late.

    Late is a write at or before the start of the open version, a delete before
    it, and every write but the first of several at the same instant.  ``late_of``
    and ``versions_of`` read the result; a job that wants both stores it between.
    """
    events = _batch_lane(batch)
    placed, hot = _in_context(_open_lane(history).unionByName(events), events, hot_rows)
    ruled = placed.withColumn("_late", F.expr(f"coalesce({_TOO_OLD}, {_REPEATED})")).drop("_open_from", "_before_kind", "_before_at")
    return kept(ruled, "ruled") if hot else ruled


def late_changes(history: DataFrame, batch: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The events of the batch that ``apply_changes`` leaves out, with the reason."""
    return late_of(ruled_changes(history, batch, hot_rows))


def late_of(ruled: DataFrame) -> DataFrame:
    """The late events of ruled rows."""
    return ruled.filter("_late is not null").selectExpr(
        "_seq as _row_sequence_id", "customer_id", "_at as _commit_timestamp", "_late as late_reason", "_bronze_batch_id"
    )


def apply_changes(history: DataFrame, batch: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Versions after the batch: the open versions it met (closed or not) and the ones it opened.

    A write closes the open version and opens one; a delete closes and flags it,
    and does nothing where none is open.  Closed versions of ``history`` are not
    part of the result.
    """
    return versions_of(ruled_changes(history, batch, hot_rows))


def versions_of(ruled: DataFrame) -> DataFrame:
    """The versions that ruled rows make."""
    closed = _with_end(ruled.filter("_late is null"), ["_kind", "_bronze_batch_id"]).filter(f"_kind != {_DELETE}")
    deleted = f"coalesce(_end_kind = {_DELETE}, false)"
    return closed.withColumns(
        {
            "valid_from": F.col("_at"),
            "valid_to": F.expr(f"coalesce(_end, {C.END_OF_TIME})"),
            "is_current": F.expr("cast(_end is null as int)"),
            "is_deleted": F.expr(f"cast({deleted} as int)"),
            "_bronze_batch_id": F.expr(f"if({deleted}, _end_bronze_batch_id, _bronze_batch_id)"),
        }
    ).select(HISTORY_COLUMNS)


def merge_history(history: DataFrame, batch: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The whole history after the batch."""
    return history.filter("is_current = 0").select(HISTORY_COLUMNS).unionByName(
        apply_changes(history, batch, hot_rows)
    )


def empty_history(batch: DataFrame) -> DataFrame:
    """An empty history table, for the first batch."""
    spark = batch.sparkSession
    text = ["customer_sk", "customer_id", "first_name", "last_name", "email", "state"]
    fields = [f"{c} string" for c in text] + [
        "valid_from timestamp_ntz", "valid_to timestamp_ntz", "is_current int", "is_deleted int",
        "_bronze_batch_id string",
    ]
    return spark.createDataFrame([], ", ".join(fields))


# --- staged merge -------------------------------------------------------------------

STAGED_VERSION_COLUMNS = [
    "customer_id", "first_name", "last_name", "email", "state", "_commit_timestamp",
    "is_current", "valid_from", "valid_to", "is_deleted",
]


def net_changes(clean: DataFrame) -> DataFrame:
    """All changes with a key that can alter the table: no before-images.  A key may have several; each counts."""
    return clean.filter((F.col("_change_type") != S.UPDATE_BEFORE) & F.col("customer_id").isNotNull())


def _staged(target: DataFrame, changes: DataFrame, hot_rows: int) -> tuple[DataFrame, bool]:
    """Current versions and net changes of each key in order, in one pass; whether a key is hot.

    ``_stale`` changes lie at or before the start of the current version, ``_is_first``
    is the first change of a key that does not.  ``_version`` and ``_change`` hold the rows.
    """
    events = net_changes(changes).select(
        "customer_id", F.expr("_commit_timestamp as _at"), F.expr("_row_sequence_id as _seq"), F.lit(1).alias("_rank"),
        F.expr(f"if(_change_type = '{S.DELETE}', {_DELETE}, {_WRITE}) as _kind"), F.struct(*changes.columns).alias("_change"),
    )
    current = target.filter("is_current = 1").select(
        "customer_id", F.expr("valid_from as _at"), F.lit(-1).cast("bigint").alias("_seq"), F.lit(0).alias("_rank"),
        F.lit(_OPEN).alias("_kind"), F.struct(*STAGED_VERSION_COLUMNS).alias("_version"),
    )
    placed, hot = _in_context(current.unionByName(events, allowMissingColumns=True), events, hot_rows)
    stale, follows = f"_kind != {_OPEN} and coalesce(_at <= _open_from, false)", "_before_at > coalesce(_open_from, timestamp_ntz'0001-01-01')"
    told = placed.withColumn("_stale", F.expr(stale)).withColumn(
        "_is_first", F.expr(f"_kind != {_OPEN} and not _stale and not coalesce(_before_kind != {_OPEN} and {follows}, false)")
    ).withColumn("_known", F.col("_open_from").isNotNull()).drop("_open_from", "_before_kind", "_before_at")
    return (kept(told, "staged") if hot else told), hot


def staged_changes(target: DataFrame, changes: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Merge source: the first change of each key under it, and under a NULL key what must insert a version.

    A merge source may hold a key only once: the first change closes the current
    version, or inserts where there is none.  The NULL-key rows are the writes that
    meet a current version and all later writes.  Stale changes are no part of it.
    """
    told = _staged(target, changes, hot_rows)[0].filter(f"_kind != {_OPEN} and not _stale")
    inserts = F.expr(f"_kind = {_WRITE} and (_known or not _is_first)")
    keys = F.array_compact(F.array(F.when(F.col("_is_first"), F.struct(F.col("customer_id").alias("k"))), F.when(inserts, F.struct(F.lit(None).cast("string").alias("k")))))
    return told.select("_change.*", F.explode(keys).alias("_key")).withColumn("merge_key", F.col("_key.k")).drop("_key")


def stale_changes(target: DataFrame, changes: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The changes that ``staged_merge`` leaves out: at or before the start of the current version."""
    return _staged(target, changes, hot_rows)[0].filter("_stale").select("_change.*")


def staged_merge(target: DataFrame, changes: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The table after the three clauses for every change of a key in order: retire on write, retire and flag on delete, insert on write.

    These are the rows of ``staged_changes`` with the change that follows each: the
    first change of a key ends its current version, the writes follow each other as in
    ``first_load``.  Writes insert whether or not the key is known, so a key that was
    deleted and comes back gets a version.  Current versions and changes are sorted
    once; versions that are not current are carried over as they are.
    """
    told, _ = _staged(target, changes, hot_rows)
    ended = _with_end(told.filter("not _stale").drop("_stale", "_is_first", "_known"), ["_kind"]).filter(f"_kind != {_DELETE}")
    was, gone, open_ended = F.col("_kind") == _OPEN, F.coalesce(F.col("_end_kind") == _DELETE, F.lit(False)), F.col("_end").isNull()
    taken = {c: F.when(was, F.col("_version")[c]).otherwise(F.col("_change")[c]) for c in ["first_name", "last_name", "email", "state", "_commit_timestamp"]}
    merged = ended.withColumns(
        taken
        | {
            "is_current": F.when(was & open_ended, F.col("_version.is_current")).otherwise(open_ended.cast("int")),
            "valid_from": F.col("_at"),
            "valid_to": F.coalesce(F.col("_end"), F.when(was, F.col("_version.valid_to")), C.end_of_time()),
            "is_deleted": F.when(gone, 1).when(was, F.col("_version.is_deleted")).otherwise(0),
        }
    )
    return target.filter("is_current = 0").select(STAGED_VERSION_COLUMNS).unionByName(merged.select(STAGED_VERSION_COLUMNS))


def first_load(clean: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """History for a target that does not exist yet, in the layout of ``staged_merge``.

    Rows keep their text as it came: this path neither trims nor masks.
    """
    timed = with_neighbour(
        net_changes(clean), "customer_id", ["_commit_timestamp", "_row_sequence_id"],
        ["_commit_timestamp", "_change_type"], "next", "_next", hot_rows,
    ).filter(F.col("_change_type") != S.DELETE)
    open_ended = F.col("_next_commit_timestamp").isNull()
    deleted = F.coalesce(F.col("_next_change_type") == S.DELETE, F.lit(False))
    return timed.withColumns(
        {
            "valid_from": F.col("_commit_timestamp"),
            "valid_to": F.coalesce("_next_commit_timestamp", C.end_of_time()),
            "is_current": open_ended.cast("int"),
            "is_deleted": deleted.cast("int"),
        }
    ).select(STAGED_VERSION_COLUMNS)


# --- upserts -------------------------------------------------------------------------


def upsert(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Rows of ``incoming`` replace rows of the same key; both sides hold a key once."""
    untouched = target.join(incoming.select(key), key, "left_anti")
    return untouched.select(target.columns).unionByName(incoming.select(target.columns))


def upsert_changes(target: DataFrame, batch: DataFrame, key: str, apply_deletes: bool = True) -> DataFrame:
    """Apply the last change of each key; a delete removes the row, or is kept as a row when not applied."""
    last = latest_per_key(batch, key, ["_commit_timestamp", "_row_sequence_id"])
    untouched = target.join(last.select(key), key, "left_anti")
    rows = last.filter(F.col("_change_type") != S.DELETE) if apply_deletes else last
    return untouched.select(target.columns).unionByName(rows.select(target.columns))
