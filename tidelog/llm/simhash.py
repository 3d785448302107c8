"""Near copies by SimHash fingerprints, compared as vertical bit planes.

Texts with one fingerprint are one class, found by an aggregation.  Two
fingerprints within ``radius`` bits agree on at least MATCH of ``radius + MATCH``
segments, so classes meet under every choice of MATCH equal segments; that loses no
link.  Classes that share a choice are compared bit-sliced: bit i of 64 of them is
one machine word, carry-save adders count differing planes in all of them at once,
and a word is abandoned as soon as its 64 counts exceed the radius.  A bucket
returns a spanning forest of its links, never its pairs.  Components of the links
are the groups.

Null text: like an empty one, fingerprint zero.  Equal texts and repeated rows share
a class.  Null ids are kept and never smallest; a group of null ids only has the
component null.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import per_text, stored, words_of
from tidelog.llm.components import components

SHINGLE, RADIUS, MATCH, SEED = 3, 2, 3, 42
_CHUNK = 65_536
_QUERIES = 64
#: A bucket above this many classes is divided again by segments of the bits its key leaves open.
_LARGE = 4_096


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits, each set if more than half of the shingle hashes have it; 0 without words."""
    words = words_of(text, lower=True)
    if not words:
        return 0
    shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle))))) if len(words) >= shingle else [b" ".join(words)]
    ones = np.zeros(64, np.int64)
    for start in range(0, len(shingles), _CHUNK):
        part = shingles[start : start + _CHUNK]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(SEED)), np.uint64, len(part))
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(shingles)).tobytes(), "big")


def fingerprints(documents: DataFrame, text: str = "text", keep: list[str] | None = None, shingle: int = SHINGLE) -> DataFrame:
    """``fp``, the fingerprint as a signed long, of every text, after the ``keep`` columns."""

    def work(texts: list[bytes]) -> dict[str, list]:
        values = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
        return {"fp": values.view(np.int64).tolist()}

    return per_text(documents, text, keep or [], "fp bigint", work)


def segments(radius: int, bits: list[int] | None = None) -> list[int]:
    """Masks of ``radius + MATCH`` consecutive segments of the given bit positions (all 64)."""
    bits = list(range(64)) if bits is None else bits
    parts = np.array_split(bits, radius + MATCH)
    return [sum(1 << int(b) for b in part) for part in parts]


def choices(masks: list[int], match: int = MATCH) -> list[int]:
    """The unions of every ``match`` of the masks."""
    return [sum(chosen) for chosen in combinations(masks, match)]


def planes_of(values: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of all values, 64 values to a word."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    padded = np.zeros((64, -(-len(values) // 64) * 64), np.uint8)
    padded[:, : len(values)] = bits.T
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def near(values: np.ndarray, planes: np.ndarray, first: int, last: int, radius: int, order: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j), first <= i < last and i < j, whose values differ in at most ``radius`` of the ``order`` bits."""
    words, n = planes.shape[1], len(values)
    queries = np.arange(first, last)
    start = first // 64
    q, w = (x.ravel() for x in np.meshgrid(queries, np.arange(start, words), indexing="ij"))
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    # dead: values at or before the query, and the padding of the last word
    dead = np.where(w < q // 64, full, np.uint64(0))
    own = w == q // 64
    shift = (q[own] % 64).astype(np.uint64)
    dead[own] = (np.uint64(2) << shift) - np.uint64(1)
    if n % 64:
        dead[w == words - 1] |= full << np.uint64(n % 64)
    width = max(2, radius.bit_length() + 1)
    counters = [np.zeros(len(q), np.uint64) for _ in range(width)]
    for at in range(0, len(order), 3):
        group = order[at : at + 3]
        inputs = [planes[b][w] ^ (np.uint64(0) - ((values[q] >> np.uint64(b)) & np.uint64(1))) for b in group]
        if len(inputs) == 3:
            a, b, c = inputs
            half = a ^ b
            ones, twos = half ^ c, (a & b) | (half & c)
        elif len(inputs) == 2:
            ones, twos = inputs[0] ^ inputs[1], inputs[0] & inputs[1]
        else:
            ones, twos = inputs[0], np.zeros_like(inputs[0])
        carry = counters[0] & ones
        counters[0] = counters[0] ^ ones
        both = counters[1] ^ twos
        over = (counters[1] & twos) | (both & carry)
        counters[1] = both ^ carry
        for level in range(2, width):
            over, counters[level] = counters[level] & over, counters[level] ^ over
        dead |= over
        above, equal = np.zeros_like(dead), np.full_like(dead, full)
        for level in range(width - 1, -1, -1):
            if not radius >> level & 1:
                above |= equal & counters[level]
                equal &= ~counters[level]
            else:
                equal &= counters[level]
        dead |= above
        live = dead != full
        if not live.all():
            q, w, dead = q[live], w[live], dead[live]
            counters = [c[live] for c in counters]
        if not len(q):
            break
    if not len(q):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, bits = np.nonzero(np.unpackbits((~dead).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    return q[rows], w[rows] * 64 + bits


def forest(values: np.ndarray, radius: int, mask: int) -> np.ndarray:
    """For each value, the index of the smallest value of its group by links among ``values``.

    All values agree on the bits of ``mask``.  The values are distinct and sorted.
    """
    label = np.arange(len(values))
    open_bits = [b for b in range(64) if not mask >> b & 1]
    if len(values) <= _LARGE or len(open_bits) < radius + MATCH:
        _join(values, np.arange(len(values)), radius, open_bits, label)
        return label
    for inner in choices(segments(radius, open_bits)):
        key = values & np.uint64(inner)
        order = np.argsort(key, kind="stable")
        cuts = np.flatnonzero(np.diff(key[order])) + 1
        rest = [b for b in open_bits if not inner >> b & 1]
        for members in np.split(order, cuts):
            if len(members) > 1:
                _join(values[members], members, radius, rest, label)
    return label


def _join(values: np.ndarray, members: np.ndarray, radius: int, order: list[int], label: np.ndarray) -> None:
    """Merge the labels of linked members; takes _QUERIES values at a time against all later ones."""
    planes = planes_of(values)
    for first in range(0, len(values), _QUERIES):
        i, j = near(values, planes, first, min(first + _QUERIES, len(values)), radius, order)
        i, j = members[i], members[j]
        while len(i):
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            low = np.minimum(a, b)
            np.minimum.at(label, np.maximum(a, b), low)
            while not np.array_equal(label[label], label):
                label[:] = label[label]


def links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``a``, ``b`` that connect exactly the ``fp`` of the frame within reach of each other.

    The fingerprints must be distinct.  Buckets of one class never leave the JVM.
    """
    masks = choices(segments(radius))
    keys = [F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m).cast("bigint")) for m in masks]
    keyed = classes.select("fp", F.posexplode(F.array(*keys)).alias("choice", "key"))
    bucket = Window.partitionBy("choice", "key")
    shared = keyed.withColumn("n", F.count(F.lit(1)).over(bucket)).filter("n > 1").select("choice", "key", "fp")

    def compare(choice: int, found: list[np.ndarray]) -> pd.DataFrame:
        values = np.sort(np.concatenate(found).astype(np.int64).view(np.uint64))
        label = forest(values, radius, masks[choice])
        linked = np.flatnonzero(label != np.arange(len(values)))
        return pd.DataFrame({"a": values[linked].view(np.int64), "b": values[label[linked]].view(np.int64)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, found = None, []
        for batch in batches:
            choice, key, fp = (batch[c].to_numpy() for c in ("choice", "key", "fp"))
            cuts = np.flatnonzero((np.diff(choice) != 0) | (np.diff(key) != 0)) + 1
            out = []
            for begin, end in zip([0, *cuts], [*cuts, len(fp)]):
                if begin == end:
                    continue
                this = (int(choice[begin]), int(key[begin]))
                if this != current:
                    if current is not None:
                        out.append(compare(current[0], found))
                    current, found = this, []
                found.append(fp[begin:end])
            if out:
                yield pd.concat(out)
        if current is not None:
            yield compare(current[0], found)

    # the window has dealt and sorted the rows by (choice, key); the sort below states what the stream relies on
    return shared.sortWithinPartitions("choice", "key").mapInPandas(run, "a bigint, b bigint")


def groups(documents: DataFrame, text: str = "text", id_: str = "doc_id", shingle: int = SHINGLE, radius: int = RADIUS, keep: list[str] | None = None) -> DataFrame:
    """``id_``, the ``keep`` columns, ``fp``, ``root`` (a fingerprint naming the group) and ``component_id``, one row for each document."""
    kept = [id_, *(keep or [])]
    marked = stored(fingerprints(documents, text, kept, shingle), "simhash")
    classes = stored(marked.groupBy("fp").agg(F.min(id_).alias("_first")), "simhash-classes")
    roots = components(links(classes.select("fp"), radius))
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").selectExpr("fp", "coalesce(root, fp) as root", "_first")
    smallest = named.groupBy("root").agg(F.min("_first").alias("component_id"))
    by_class = named.join(smallest, "root").select("fp", "root", "component_id")
    return marked.join(by_class, "fp").select(*[F.col(f"`{c}`") for c in kept], "fp", "root", "component_id")


def one_of_each(documents: DataFrame, text: str = "text", id_: str = "doc_id", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of each group, all columns unchanged: the smallest id, of several with it the smallest hash of the row.

    Only ids and fingerprints take part in the comparison.  Texts are shuffled
    once, to meet the rows that stay.
    """
    columns = documents.columns
    hashed = documents.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_all"), F.xxhash64(*[F.col(f"`{c}`") for c in columns]).alias("_row"))
    source = hashed.select(F.col(f"_all.`{text}`").alias("_body"), F.col(f"_all.`{id_}`").alias("_id"), "_row")
    found = groups(source, "_body", "_id", shingle, radius, ["_row"])
    # nulls last: an id before none
    staying = found.groupBy("root").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_row")).alias("s")).select(
        F.col("s._id").alias("_stay_id"), F.col("s._row").alias("_stay_row")
    )
    chosen = hashed.join(staying, F.expr(f"_all.`{id_}` <=> _stay_id and _row = _stay_row"))
    first = F.row_number().over(Window.partitionBy("_stay_id", "_stay_row").orderBy("_row"))
    return chosen.withColumn("_copy", first).filter("_copy = 1").select("_all.*")
