"""Reading the change feed: increments of a log table, and files of change events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import schemas as S
from tidelog.functions import columns as C

FIRST_ID = 0
FILE_EVENTS = 200_000


def changes_after(log: DataFrame, mark: DataFrame, ordered: bool = False) -> DataFrame:
    """Events above the high-water mark (a frame of one row).

    The mark is a scalar subquery, whose value reaches the scan as a pushed filter.
    Event order lives in the sequence column, and later steps order per key, so a
    sort of the whole increment is only made when a consumer asks for it.
    """
    rows = log.filter(F.col("_row_sequence_id") > mark.select("last_processed_id").scalar())
    return rows.orderBy("_row_sequence_id") if ordered else rows


def high_water_mark(log: DataFrame, last_id: Column | None = None, last_at: Column | None = None) -> DataFrame:
    """The next mark: the largest id and instant seen, never below the old ones."""
    last_id = F.lit(FIRST_ID).cast("long") if last_id is None else last_id
    last_at = C.start_of_time() if last_at is None else last_at
    return log.agg(F.max("_row_sequence_id").alias("i"), F.max("_commit_timestamp").alias("t")).select(
        F.greatest(F.col("i"), last_id).alias("last_processed_id"),
        F.greatest(F.col("t"), last_at).alias("last_processed_timestamp"),
    )


def entity_changes(log: DataFrame, entity: str) -> DataFrame:
    """The events of one entity with that entity's columns."""
    return log.filter(F.col("entity_type") == entity).select(S.CHANGE_COLUMNS + S.ENTITY_COLUMNS[entity])


# --- files of change events --------------------------------------------------------------
#
# Every array element (or line) is told apart first and typed afterwards, so a value
# that does not fit costs its own event and nothing beside it, and what is refused
# keeps its text.


def read_elements(spark: SparkSession, path: str, whole_file_arrays: bool = False) -> DataFrame:
    """The elements of JSON change files, as ``elements`` gives them.

    Files may hold one event or one array of events per line.  A file that is one
    pretty-printed array needs ``whole_file_arrays``, which makes each file one
    task: keep such files small.
    """
    return elements(spark.read.text(path, wholetext=whole_file_arrays))


def elements(lines: DataFrame) -> DataFrame:
    """One row per array element or single event: its JSON text ``element`` and its fields ``event``, a map of text.

    A line that is no valid JSON stays whole; it and elements that are no object
    have a NULL ``event``.  Blank lines and empty arrays give nothing.
    """
    text = F.col("value")
    wrapped = F.when(F.ltrim(text).startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    read = F.transform(
        F.from_json(wrapped, "array<string>"),
        lambda e: F.struct(F.coalesce(e, F.lit("null")).alias("element"), F.lit(True).alias("valid")),
    )
    whole = F.array(F.struct(text.alias("element"), F.lit(False).alias("valid")))
    told = lines.filter(text.rlike(r"\S")).select(F.explode(F.coalesce(read, whole)).alias("e")).select("e.*")
    is_object = F.col("valid") & F.ltrim("element").startswith("{")
    event = F.when(is_object, F.from_json("element", "map<string,string>")).alias("event")
    # no filter is pushed below an explode: pushed below a plain column, it would parse the element for each field it names
    return told.select(F.explode(F.array(F.struct("element", event))).alias("e")).select("e.*")


def _misfit(schema: T.StructType) -> Column:
    """Why an element is no event: it cannot be read, says not what changed when, or has a value that is not of its field's type.

    Numbers must be finite and small enough to be summed as money.
    """
    found = [F.when(F.col("event").isNull(), "Unreadable")]
    for field in schema.fields:
        given = F.col("event")[field.name]
        if field.name in S.CHANGE_COLUMNS:
            found.append(F.when(given.isNull() | (F.trim(given) == ""), f"Missing {field.name}"))
        if not isinstance(field.dataType, T.StringType):
            typed = given.try_cast(field.dataType)
            wrong = given.isNotNull() & typed.isNull()
            if isinstance(field.dataType, T.DoubleType):
                wrong = wrong | ~C.is_money(typed)
            found.append(F.when(wrong, F.concat(F.lit(f"Invalid {field.name}: '"), given, F.lit("'"))))
    return F.coalesce(*found)


def read_as(told: DataFrame, schema: T.StructType = S.CHANGE_LOG_SCHEMA) -> DataFrame:
    """All elements judged once: ``reason`` (NULL for events), ``element`` and the typed fields; ``events_in`` and ``refused_in`` divide them."""
    known = F.array(*[F.lit(c) for c in schema.names])
    extra = F.map_filter("event", lambda k, v: ~F.array_contains(known, k) & v.isNotNull())
    columns = [F.col("event")[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields]
    reason = _misfit(schema)
    return told.select(
        reason.alias("reason"), F.when(reason.isNotNull(), F.col("element")).alias("element"), *columns,
        F.when(F.size(extra) > 0, extra).alias(S.EXTRA),
    )


def events_in(judged: DataFrame) -> DataFrame:
    return judged.filter("reason is null").drop("reason", "element")


def refused_in(judged: DataFrame, quarantined_at: Column) -> DataFrame:
    return judged.filter("reason is not null").select("entity_type", "reason", F.col("element").alias("record"), quarantined_at.alias("quarantined_at"))


def typed_events(told: DataFrame, schema: T.StructType = S.CHANGE_LOG_SCHEMA) -> DataFrame:
    """The elements that fit the schema, with its columns and the undeclared ones as a map (NULL without any)."""
    return events_in(read_as(told, schema))


def refused_elements(
    told: DataFrame, quarantined_at: Column, schema: T.StructType = S.CHANGE_LOG_SCHEMA
) -> DataFrame:
    """The other elements as quarantine documents, with the reason and the text."""
    return refused_in(read_as(told, schema), quarantined_at)


def read_change_files(
    spark: SparkSession, path: str, schema: T.StructType = S.CHANGE_LOG_SCHEMA, whole_file_arrays: bool = False
) -> DataFrame:
    """The events of JSON change files; ``refused_elements`` gives what is left out."""
    return typed_events(read_elements(spark, path, whole_file_arrays), schema)


def append_topic(events: DataFrame, path: str) -> None:
    """Append events to a folder of JSON lines, compressed; a file is read by one task, so it has at most FILE_EVENTS."""
    written = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "compression": "gzip", "maxRecordsPerFile": FILE_EVENTS}
    events.write.mode("append").options(**written).json(path)
