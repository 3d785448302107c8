"""Importance resampling of documents towards a target distribution of n-grams.

Features of a text are its runs of one to ``ORDER`` words; a feature's bucket is the
crc32 of its bytes modulo ``BUCKETS``.  All documents and all target texts give counts
for each bucket, these a gain in thousandths for each bucket, and a document weighs
the floored mean of the gains of its features.  With Gumbel noise added to the weight,
the highest scores are a draw without replacement in proportion to exp(weight).

Within a task the features of a batch are interned in an open-addressed NumPy table:
their xxhash64 names the first place to look at, bytes decide whether two features
are one, and a feature that meets another one goes to the next place, all features of
the batch at once.  A place holds its feature's bucket and count.  Counting adds the
counts of the places by bucket; weighing gives each place its gain, which the
occurrences gather through the places they were interned at.

The draw is one range sort of ids and scores, no texts: a rank is the place of a row
within its partition after the rows of the partitions before it.

Null texts have no words.  A text of any length is taken in pieces.  Invalid UTF-8
counts as characters of words, byte by byte.  A null id draws its noise as the empty
id and comes after all other ids.  Repeated rows are documents of their own, with one
score; which of them ranks first is as good as arbitrary.  Empty documents give an
empty result, an empty target gains of the smoothing alone.  Columns other than id
and text are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import slices, stored, text_bytes

ORDER, BUCKETS, SEED, SHARE, MIN_WORDS = 2, 10_000, 7, 25, 20

#: Bytes of words: 0-9, a-z and all of characters above 127; A-Z are lower-cased, the rest parts words.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))

#: Bytes of a text, and of texts together, whose features are interned at once; their table fits into a core's cache.
_PIECE = 1 << 17

#: Bytes of a feature that are compared in NumPy; longer ones are compared one by one as well.
_INLINE = 32


class Interned:
    """An open-addressed table of the features of a batch.

    ``place`` is where each occurrence was interned.  Of each place, ``bucket`` and
    ``count`` hold the bucket and the occurrences of its feature; free places count none.
    """

    def __init__(self, features: list[bytes], buckets: int = BUCKETS):
        n = len(features)
        size = 1 << max(4, (2 * n - 1).bit_length())  # at most half full
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, features), np.uint64, n)
        lengths = np.fromiter(map(len, features), np.int64, n)
        head = np.array(features, f"S{_INLINE}").view(np.uint64).reshape(n, -1) if n else np.zeros((0, _INLINE // 8), np.uint64)
        owner = np.full(size, -1, np.int64)
        self.place = (hashes & np.uint64(size - 1)).astype(np.int64)
        looking = np.arange(n)
        while len(looking):
            at = self.place[looking]
            free = owner[at] < 0
            owner[at[free]] = looking[free]  # one of several that meet at a free place has it
            holder = owner[at]
            same = (hashes[holder] == hashes[looking]) & (lengths[holder] == lengths[looking]) & (head[holder] == head[looking]).all(axis=1)
            for i in np.flatnonzero(same & (lengths[looking] > _INLINE) & (holder != looking)):
                same[i] = features[holder[i]] == features[looking[i]]
            looking = looking[~same]
            self.place[looking] = (self.place[looking] + 1) & (size - 1)
        self.count = np.bincount(self.place, minlength=size)
        taken = np.flatnonzero(owner >= 0)
        self.bucket = np.zeros(size, np.int64)
        self.bucket[taken] = np.fromiter(map(zlib.crc32, map(features.__getitem__, owner[taken].tolist())), np.int64, len(taken)) % buckets


def pieces(text: bytes, size: int = _PIECE) -> Iterator[list[bytes]]:
    """The words of a text, lower-cased, about ``size`` bytes of it at a time; one empty list at least."""
    if len(text) <= size:
        yield text.translate(_WORDS).split()
        return
    clean, start = text.translate(_WORDS), 0
    while len(clean) - start > size:
        cut = clean.rfind(b" ", start, start + size)
        cut = cut if cut > start else clean.find(b" ", start + size)
        if cut < 0:
            break
        yield clean[start:cut].split()
        start = cut
    yield clean[start:].split()


def runs(words: list[bytes], before: list[bytes], order: int) -> list[bytes]:
    """All runs of up to ``order`` words that end in ``words``; ``before`` are the ``order - 1`` words before them, or fewer."""
    found = list(words)
    whole = before + words
    for n in range(2, order + 1):
        line = whole[max(0, len(before) - n + 1) :]
        found += map(b" ".join, zip(*(line[i:] for i in range(n))))
    return found


def _batches(texts: list[bytes], order: int) -> Iterator[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Features to intern at once, with (text, number of features, number of words) of each run of them."""
    features: list[bytes] = []
    owners: list[tuple[int, int, int]] = []
    size = 0
    for i, text in enumerate(texts):
        before: list[bytes] = []
        for words in pieces(text):
            found = runs(words, before, order)
            before = (before + words)[1 - order :] if order > 1 else []
            features += found
            owners.append((i, len(found), len(words)))
            size += min(len(text), _PIECE)
            if size >= _PIECE:
                yield features, owners
                features, owners, size = [], [], 0
    if owners:
        yield features, owners


def counted(texts: DataFrame, text: str = "text", order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """``bucket``, ``n``: occurrences of features over all texts; each task adds up its own before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch):
                for features, _ in _batches(part.column(0).to_pylist(), order):
                    table = Interned(features, buckets)
                    np.add.at(total, table.bucket, table.count)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    found = texts.select(text_bytes(text).alias("_text")).mapInArrow(run, "bucket int, n bigint")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of each bucket from the counts of raw and target texts, in thousandths of a nat, rounded down.

    Every bucket counts one more than it holds.  One number for each bucket comes to
    the driver, however large the tables are.
    """
    s, t = (np.zeros(buckets) for _ in range(2))
    for into, counts in ((s, raw), (t, target)):
        for row in counts.select("bucket", "n").collect():
            into[row.bucket] = row.n
    return np.floor(1000 * np.log(((t + 1) * (s.sum() + buckets)) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weighed(documents: DataFrame, gain: np.ndarray, text: str = "text", id_: str = "doc_id", order: int = ORDER) -> DataFrame:
    """``id_``, ``_words``, ``_features`` and ``_weight``, the floored mean gain of the features (0 without any), of every row."""
    buckets = len(gain)
    source = documents.select(text_bytes(text).alias("_text"), F.col(f"`{id_}`").alias("_id"))
    schema = source.select("_id").withColumn("_words", F.lit(0).cast("bigint")).withColumn("_features", F.lit(0).cast("bigint")).withColumn("_weight", F.lit(0).cast("bigint")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = part.column(0).to_pylist()
                words, features, sums = (np.zeros(len(texts), np.int64) for _ in range(3))
                for found, owners in _batches(texts, order):
                    table = Interned(found, buckets)
                    by_place = gain[table.bucket]
                    upto = np.concatenate([[0], np.cumsum(by_place[table.place])])
                    rows, n_features, n_words = np.array(owners, np.int64).T
                    ends = np.cumsum(n_features)
                    np.add.at(sums, rows, upto[ends] - upto[ends - n_features])
                    np.add.at(features, rows, n_features)
                    np.add.at(words, rows, n_words)
                weight = np.where(features > 0, sums // np.maximum(features, 1), 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.array(words), pa.array(features), pa.array(weight)], names=["_id", "_words", "_features", "_weight"]
                )

    return source.mapInArrow(run, schema)


def noise(id_: str, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, rounded down, from the first 32 bits of the SHA-256 of seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """The rows with ``_rank`` 1, 2, 3 ... in the given order, without a window over all of them.

    The rows are sorted into ranges and stored, each with the number of its range;
    rows that are equal in ``order`` may lie in several ranges.
    """
    fixed = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "resampling")
    dealt = fixed.repartitionByRange(*order, F.col("_row")).withColumn("_range", F.spark_partition_id())
    dealt = stored(dealt, "resampling-ranges")
    sizes = dealt.groupBy("_range").count()
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    starts = sizes.select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order, "_row"))
    return dealt.withColumn("_within", within).join(starts, "_range").withColumn("_rank", F.col("_before") + F.col("_within")).drop(
        "_row", "_range", "_within", "_before"
    )


def resample(
    documents: DataFrame,
    target: DataFrame,
    text: str = "text",
    id_: str = "doc_id",
    share: int = SHARE,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    order: int = ORDER,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``id_``, ``n_features``, ``weight``, ``score`` and ``rank`` of every document; rank is null where it is not drawn.

    Of the N documents with at least ``min_words`` words, floor(share * N / 100) are
    drawn, highest scores first, of equal scores the smaller id.  Texts are read twice
    and never shuffled.
    """
    gain = gains(counted(documents, text, order, buckets), counted(target, text, order, buckets), buckets)
    rows = weighed(documents, gain, text, id_, order)
    scored = stored(rows.withColumn("_score", F.col("_weight") + noise("_id", seed)), "resampling-scores")
    enough = F.col("_words") >= min_words
    drawn = scored.filter(enough).count() * share // 100
    order_ = [F.col("_score").desc(), F.col("_id").asc_nulls_last()]
    in_order = ranked(scored.filter(enough), order_).withColumn("_rank", F.expr(f"if(_rank <= {drawn}L, _rank, null)"))
    rest = scored.filter(~enough).withColumn("_rank", F.lit(None).cast("bigint"))
    return in_order.unionByName(rest).select(
        F.col("_id").alias(id_), F.col("_features").alias("n_features"), F.col("_weight").alias("weight"), F.col("_score").alias("score"), F.col("_rank").alias("rank")
    )
