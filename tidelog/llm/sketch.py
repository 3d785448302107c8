"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch holds the K smallest distinct 64-bit hashes of a text's shingles of five
words (A-Z lower-cased; fewer words: the whole sequence is one shingle).  Sketches
of parts merge into the sketch of the whole: the K smallest of their union.  Two
sketches estimate resemblance from the K smallest of their union, the number of
distinct shingles from the K-th hash, and containment from both.

Null and empty texts have the empty sketch: equal to each other (resemblance 1),
unlike any other (0), contained in everything.  Equal texts have equal sketches.
A sketch travels as sorted big-endian hashes, base64 in text form.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import held, per_text, valid_text, words_of

K, SHINGLE, SEED = 128, 5, 42
_MEMO, _CHUNK = 400_000, 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.array([pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(64)], np.uint64)


class Sketcher:
    """Makes sketches; remembers word hashes, up to a bound."""

    def __init__(self, k: int = K, shingle: int = SHINGLE):
        self.k, self.shingle = k, shingle
        self.memo: dict[bytes, int] = {}

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        memo = self.memo
        found = list(map(memo.get, words))
        if None in found:
            if len(memo) > _MEMO:
                memo.clear()
            for i, value in enumerate(found):
                if value is None:
                    found[i] = memo[words[i]] = xxhash.xxh64_intdigest(words[i], SEED)
        return np.array(found, np.uint64)

    def sketch(self, text: bytes) -> np.ndarray:
        """The ``k`` smallest distinct shingle hashes, ascending; chunk by chunk, so memory is bounded by the words."""
        words = words_of(text, lower=True)
        size = min(self.shingle, len(words))
        best = np.zeros(0, np.uint64)
        for start in range(0, len(words) - size + 1 if words else 0, _CHUNK):
            hashes = self._hashes(words[start : start + _CHUNK + size - 1])
            n = len(hashes) - size + 1
            with np.errstate(over="ignore"):
                rolled = np.full(n, size, np.uint64)
                for i in range(size):
                    rolled += hashes[i : i + n] * _POWERS[size - i]
                rolled = mixed(rolled)
            best = smallest(np.concatenate([best, rolled]), self.k)
        return best


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def smallest(values: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` smallest distinct values, ascending."""
    if len(values) > 8 * k:
        # repeats may crowd the first part, so widen it until it holds k distinct values
        part = 2 * k
        while part < len(values):
            found = np.unique(np.partition(values, part)[:part])
            if len(found) >= k:
                return found[:k]
            part *= 4
    return np.unique(values)[:k]


def merge(sketches: list[np.ndarray], k: int = K) -> np.ndarray:
    """The sketch of all parts together."""
    return smallest(np.concatenate([np.zeros(0, np.uint64), *sketches]), k)


def distinct(sketch: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact while there are fewer than ``k``."""
    return float(len(sketch)) if len(sketch) < k else (k - 1) / ((float(sketch[-1]) + 1) / 2.0**64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated shared part of all shingles of both; exact while there are fewer than ``k`` together."""
    union = merge([a, b], k)
    if not len(union):
        return 1.0
    shared = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(union, shared, assume_unique=True).sum() / len(union))


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated part of the shingles of ``a`` that ``b`` has too."""
    if not len(a):
        return 1.0
    if len(a) < k and len(b) < k:
        return float(len(np.intersect1d(a, b, assume_unique=True)) / len(a))
    return min(1.0, resemblance(a, b, k) * distinct(merge([a, b], k), k) / distinct(a, k))


def packed(sketch: np.ndarray) -> bytes:
    return sketch.astype(">u8").tobytes()


def unpacked(data: bytes | None) -> np.ndarray:
    return np.frombuffer(data or b"", ">u8").astype(np.uint64)


def as_text(sketch: np.ndarray) -> str:
    return base64.b64encode(packed(sketch)).decode()


def sketches(documents: DataFrame, text: str = "text", keep: list[str] | None = None, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """``sketch binary`` of every text, after the ``keep`` columns."""
    def work(texts: list[bytes]) -> dict[str, list]:
        maker = held(("sketch", k, shingle), lambda: Sketcher(k, shingle))
        return {"sketch": [packed(maker.sketch(t)) for t in texts]}

    return per_text(documents, text, keep or [], "sketch binary", work)


def merged_by(parts: DataFrame, by: str, k: int = K) -> DataFrame:
    """One ``sketch`` for each value of ``by``, null included: the merge of its parts.

    Every task merges what it has of a value first, so a value with most of the
    rows reaches the last merge as a few sketches for each task.
    """
    key_type = parts.schema[by].dataType.simpleString()
    schema = f"`{by}` {key_type}, sketch binary"

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[object, np.ndarray] = {}
        for frame in frames:
            for value, data in zip(frame[by], frame["sketch"]):
                value = None if pd.isna(value) else value
                kept[value] = merge([kept[value], unpacked(data)], k) if value in kept else unpacked(data)
            if len(kept) > 20_000:
                yield pd.DataFrame({by: list(kept), "sketch": list(map(packed, kept.values()))}, dtype=object)
                kept = {}
        yield pd.DataFrame({by: list(kept), "sketch": list(map(packed, kept.values()))}, dtype=object)

    def last(frame: pd.DataFrame) -> pd.DataFrame:
        whole = merge([unpacked(d) for d in frame["sketch"]], k)
        return pd.DataFrame({by: frame[by].iloc[:1], "sketch": [packed(whole)]}, dtype=object)

    return parts.select(by, "sketch").mapInPandas(fold, schema).groupBy(by).applyInPandas(last, schema)


def with_next(documents: DataFrame, text: str, id_: str, block_rows: int = 500) -> DataFrame:
    """Rows ``_id, _text, _block`` dealt by blocks of consecutive ids and sorted by id within them.

    Each block also holds the first rows of the next one (``_border``), the last
    block those of the first, so whoever reads a block in order sees the successor
    of every row.  The cut points are quantiles of the id, at most 10,000, taken
    over all ids; the texts are shuffled once.  Null ids come first.
    """
    spark = documents.sparkSession
    ids = documents.select(F.col(id_).cast("bigint").alias("_id"))
    n = ids.count()
    parts = max(1, min(10_000, n // block_rows))
    cuts = ids.agg(F.percentile_approx("_id", [i / parts for i in range(1, parts)], 100_000)).first()[0] if parts > 1 else []
    cuts = sorted(set(cuts or []))
    lowest = ids.agg(F.min(F.struct(F.col("_id").isNotNull(), "_id")).alias("s")).select("s._id").first()
    lowest = lowest[0] if lowest else None
    last = len(cuts)

    import pyarrow as pa

    starts = np.array(cuts, np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            null = np.asarray(column.is_null())
            values = column.fill_null(0).to_numpy(zero_copy_only=False)
            block = np.where(null, 0, np.searchsorted(starts, values, side="right"))
            first = null if lowest is None else ~null & (values == lowest)
            opens = ~null & np.isin(values, starts) & (block > 0)
            rows = np.concatenate([np.arange(len(values)), np.flatnonzero(opens), np.flatnonzero(first)])
            blocks = np.concatenate([block, block[opens] - 1, np.full(first.sum(), last)]).astype(np.int32)
            border = np.concatenate([np.zeros(len(values), np.int8), np.ones(opens.sum(), np.int8), np.full(first.sum(), 2, np.int8)])
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([pa.array(blocks), pa.array(border), *taken.columns], names=["_block", "_border", "_id", "_text"])

    source = documents.select(F.col(id_).cast("bigint").alias("_id"), valid_text(text).alias("_text"))
    dealt = source.mapInArrow(deal, "_block int, _border tinyint, _id bigint, _text string")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    return dealt.repartition(min(tasks, last + 1) if last + 1 < tasks else tasks, "_block").sortWithinPartitions(
        "_block", "_border", F.col("_id").asc_nulls_first(), "_text"
    )


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following one (or all of it)."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_successor(documents: DataFrame, text: str = "text", id_: str = "doc_id", k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """For every document, its sketch, that of its edited text and their likenesses, and the likeness to the next one.

    The next document is the one with the next id (of rows with one id, the next
    text; after the last, the first; a single document follows itself).
    """
    schema = (
        f"`{id_}` bigint, n_chars bigint, edited_text string, sketch binary, edited_sketch binary, "
        "near_edited double, near_next double, contained double, n_shingles double"
    )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        maker = held(("sketch", k, shingle), lambda: Sketcher(k, shingle))
        waits = None  # block, id, text, sketch of the row that waits for its successor
        for frame in frames:
            out = []
            for block, border, own, text_ in zip(frame["_block"], frame["_border"], frame["_id"], frame["_text"]):
                if border and (waits is None or waits[0] != block):
                    continue  # the second border row of a block whose rows are done
                now = (block, None if pd.isna(own) else int(own), text_, maker.sketch(text_.encode()))
                if waits is not None and waits[0] == block:
                    changed = edited(waits[2], text_)
                    other = maker.sketch(changed.encode())
                    out.append((
                        waits[1], len(waits[2]), changed, packed(waits[3]), packed(other), resemblance(waits[3], other, k),
                        resemblance(waits[3], now[3], k), containment(waits[3], other, k), distinct(waits[3], k),
                    ))
                waits = None if border else now
            if out:
                made = pd.DataFrame(out, columns=[f.split()[0].strip("`") for f in schema.split(", ")])
                made[id_] = made[id_].astype("Int64")
                yield made

    return with_next(documents, text, id_).mapInPandas(run, schema)
