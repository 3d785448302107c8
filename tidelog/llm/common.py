"""Helpers shared by the operators: words of a text, tables kept in the shared folder, crc32 folds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.workspace import new_dir

#: A-Z to a-z on UTF-8 bytes; bytes of other characters are all above 127 and stay.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Texts handled at once by a task; bounds the memory of a batch together with BATCH_BYTES.
BATCH_ROWS, BATCH_BYTES = 2_000, 16_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str) -> Column:
    """The text as UTF-8 bytes, null as empty.

    ``bytes.split()`` then gives exactly the words ``[^\\x20\\x09-\\x0D]+``.
    """
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def valid_text(column: str) -> Column:
    """The text, null as empty, with the replacement character for bytes that are no UTF-8."""
    return F.make_valid_utf8(F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("")))


def words_of(text: bytes, lower: bool = False) -> list[bytes]:
    return (text.translate(LOWER) if lower else text).split()


def split_words(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """``words_of`` every text of a column without nulls: the words of all, one text after the other, and how many each has."""
    # its kernels for ASCII leave other bytes as they are, so they need not be valid UTF-8
    whole = texts.cast(pa.binary()).view(pa.string())
    found = pc.ascii_split_whitespace(pc.ascii_lower(whole) if lower else whole)
    words, lengths = found.flatten().view(pa.binary()), pc.list_value_length(found).to_numpy()
    # white space at an end leaves an empty word there
    some = pc.binary_length(words).to_numpy() > 0
    if not some.all():
        upto = np.concatenate([[0], np.cumsum(some)])
        ends = np.cumsum(lengths)
        words, lengths = words.filter(pa.array(some)), upto[ends] - upto[ends - lengths]
    return words, lengths.astype(np.int64)


def fold_of(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written below the shared folder and read back: cuts lineage and outlives executors."""
    path = new_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


_HELD: list = [None, None]


def held(token: object, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept by the worker process for later tasks with an equal ``token``; one thing at a time."""
    if _HELD[0] != token:
        _HELD[:] = [token, make()]
    return _HELD[1]


def slices(batch: pa.RecordBatch, text: int = 0, rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``rows`` (BATCH_ROWS) rows and about BATCH_BYTES of text (one row at least)."""
    rows = rows or BATCH_ROWS
    start, size = 0, 0
    for i, length in enumerate(pc.binary_length(batch.column(text)).to_pylist()):
        if i > start and (i - start >= rows or size + (length or 0) > BATCH_BYTES):
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += length or 0
    if batch.num_rows > start:
        yield batch.slice(start)


def per_text(
    frame: DataFrame, text: str, keep: list[str], made: str, work: Callable[[list[bytes]], dict[str, list]]
) -> DataFrame:
    """``keep`` columns of every row, followed by the columns ``made`` that ``work`` gives for its text.

    ``work`` takes a list of texts as bytes and returns one list for each column
    of ``made`` (a DDL string).  The texts are valid UTF-8, by replacement characters
    if need be.  The text itself does not return to the JVM.
    """
    source = frame.select(valid_text(text).cast("binary").alias("_text"), *[F.col(f"`{c}`") for c in keep])
    added = T._parse_datatype_string(made)
    schema = T.StructType(source.schema.fields[1:] + added.fields)
    names = [f.name for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for part in slices(batch):
                out = work(part.column(0).to_pylist())
                columns = [part.column(i).cast(arrow.field(i - 1).type) for i in range(1, part.num_columns)]
                columns += [pa.array(out[n], type=arrow.field(len(keep) + i).type) for i, n in enumerate(names)]
                yield pa.RecordBatch.from_arrays(columns, names=arrow.names)

    return source.mapInArrow(run, schema)


def filtered_by_text(frame: DataFrame, text: str, keeps: Callable[[list[bytes]], list[bool]]) -> DataFrame:
    """The rows, all columns unchanged, whose text ``keeps`` accepts; extra columns may have any name.

    ``keeps`` sees replacement characters where a text is no valid UTF-8; the row keeps its bytes.
    """
    position = frame.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, position):
                # invalid bytes would stop the conversion to str
                found = part.column(position).cast(pa.binary()).to_pylist()
                texts = [(t or b"").decode(errors="replace").encode() for t in found]
                yield part.filter(pa.array(keeps(texts), type=pa.bool_()))

    return frame.mapInArrow(run, frame.schema)
