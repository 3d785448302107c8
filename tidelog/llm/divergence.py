"""Divergence of the sources of a language by their terms, found by iceberg prefix refinement.

A language keeps the terms that at least ``MIN_DOCS`` of its documents hold.  They are
found from short to long byte prefixes, without a dictionary of all terms: a level
counts the documents of each prefix of its length, prefixes below the threshold go with
all terms they begin, and the next level looks at terms of kept prefixes only.  A term
carries an end mark, a byte no term holds, so a prefix with the mark is a complete term
and is kept or dropped for good; levels double in length until no open prefix is left.
A document counts once for a prefix, whatever number of its terms begin with it, and is
read by one task, so the counts of tasks add up.

What a level hands to the next one is a bitmap of the hashes of its kept prefixes, of
``MAX_WORDS`` 64-bit words at most.  It passes every kept prefix and a few others, whose
exact counts at the next level are below the threshold as well: the bitmap's size
changes the work, never the result.

Every occurring (language, source) group, and each language, gives each kept term a
share p of a thousand million, smoothed by two occurrences.  Two groups differ by the
sum over all kept terms of floor((p - q)² / (p + q)); terms of a group that stand out
against its language have the same measure.  All of it is whole numbers, computed
without overflow for up to 9 * 10^15 terms in a group.

Null text, language and source are the empty one; groups without terms have their rows.
Repeated rows count as documents of their own.  Texts of any length are read whole, with
its terms as one Arrow column in memory.  Invalid UTF-8 counts as bytes of terms.  An empty
table gives an empty result.  Columns other than these three are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import slices, split_words, stored, text_bytes

MIN_DOCS, TOP_TERMS, UNIT = 10, 10, 1_000_000_000

#: Length of the first prefixes, in bytes; each level doubles it.
FIRST_LEVEL = 8

#: Bits for each kept prefix in the bitmap, and its largest size (16 MB).
BITS_PER_PREFIX, MAX_WORDS = 16, 1 << 21

#: A task hands on its counts at this many terms; it adds up those of its batches at twice as many.
HELD_ENTRIES = 400_000

END = b" "

#: Bytes of terms: a-z and all of characters above 127; A-Z are lower-cased, the rest parts terms.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def _rows(documents: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    part = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    return documents.select(text_bytes(text).alias("_text"), part(lang).alias("lang"), part(source).alias("source"))


class Bitmap:
    """Hashes of (language, prefix) as two bits of one word each; never denies one that was put in."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @classmethod
    def of(cls, kept: DataFrame) -> Bitmap:
        """The bits of ``lang``, ``prefix``; combined map-side, at most MAX_WORDS numbers come to the driver."""
        n = max(1, min(MAX_WORDS, -(-kept.count() * BITS_PER_PREFIX // 64)))
        h = F.xxhash64(F.concat(F.encode("lang", "UTF-8"), F.lit(b"\0"), F.col("prefix")))
        bit = lambda shift: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(63)).cast("int"))
        marked = kept.select((F.shiftrightunsigned(h, 12) % n).alias("word"), bit(0).bitwiseOR(bit(6)).alias("bits"))
        found = marked.groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
        words = np.zeros(n, np.int64)
        words[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
        return cls(words.view(np.uint64))

    def has(self, lang: bytes, prefixes: list[bytes]) -> np.ndarray:
        """Which of the prefixes of a language may have been put in; all that were."""
        head = lang + b"\0"  # hash and seed are those of xxhash64 in SQL
        h = np.fromiter((xxhash.xxh64_intdigest(head + p, 42) for p in prefixes), np.uint64, len(prefixes))
        one, low = np.uint64(1), np.uint64(63)
        bits = one << (h & low) | one << (h >> np.uint64(6) & low)
        return self.words[(h >> np.uint64(12)) % np.uint64(len(self.words))] & bits == bits


def _terms_of(texts: pa.Array, rows: list[int], shortest: int) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Terms of at least ``shortest`` bytes of these rows, one text after the other, and the position in ``rows`` of each."""
    own = texts.take(pa.array(rows, pa.int64())).cast(pa.binary())  # a copy, so its bytes begin at 0
    _, ends, data = own.buffers()
    lowered = pa.py_buffer((data.to_pybytes() if data else b"").translate(_TERMS))
    words, lengths = split_words(pa.Array.from_buffers(pa.binary(), len(own), [None, ends, lowered]))
    owner = np.repeat(np.arange(len(own)), lengths)
    if shortest > 1:
        enough = pc.greater_equal(pc.binary_length(words), shortest)
        words, owner = words.filter(enough), owner[enough.to_numpy(zero_copy_only=False)]
    return words.dictionary_encode(), owner


def _by_language(
    batches: Iterator[pa.RecordBatch], shortest: int, meaning: Callable[[bytes, pa.Array], pa.Array]
) -> Iterator[tuple[str, pa.Array, np.ndarray, np.ndarray, list]]:
    """What the terms of each part of a batch mean, by language.

    ``meaning`` gives what counts for each distinct term, or null.  Yields the language,
    the distinct meanings, the number of the meaning of each occurrence that has one, the
    position of its text, and for each text the last column.
    """
    for batch in batches:
        for part in slices(batch):
            langs, keys = part.column(1).to_pylist(), part.column(part.num_columns - 1).to_pylist()
            of_lang: dict[str, list[int]] = defaultdict(list)
            for row, lang in enumerate(langs):
                of_lang[lang].append(row)
            for lang, rows in of_lang.items():
                terms, owner = _terms_of(part.column(0), rows, shortest)
                means = meaning(lang.encode(), terms.dictionary).dictionary_encode()
                numbers = means.indices.fill_null(-1).to_numpy().astype(np.int64)[terms.indices.to_numpy()]
                some = numbers >= 0
                yield lang, means.dictionary, numbers[some], owner[some], [keys[row] for row in rows]


class _Counts:
    """Counts by language, name and place that a task holds; a code is the number of a name times the language's places, plus the place."""

    def __init__(self, places: Callable[[str], int]):
        self.places = places
        self.held: dict[str, list[tuple[pa.Array, np.ndarray, np.ndarray]]] = defaultdict(list)
        self.size = 0

    def add(self, lang: str, names: pa.Array, codes: np.ndarray, n: np.ndarray) -> bool:
        """Whether the caller has to hand on what is held."""
        if len(names):
            self.held[lang].append((names, codes, n))
            self.size += len(names)
        if self.size <= 2 * HELD_ENTRIES:
            return False
        self._merge()
        return self.size > HELD_ENTRIES

    def _merge(self) -> None:
        """One part for each language, its codes ascending and each there once."""
        for lang, parts in self.held.items():
            if len(parts) > 1:
                width = self.places(lang)
                whole = pa.concat_arrays([names for names, _, _ in parts]).dictionary_encode()
                number, first, moved = whole.indices.to_numpy().astype(np.int64), 0, []
                for names, codes, _ in parts:
                    term, place = np.divmod(codes, width)
                    moved.append(number[first + term] * width + place)
                    first += len(names)
                self.held[lang] = [(whole.dictionary, *_added(np.concatenate(moved), np.concatenate([n for _, _, n in parts])))]
                self.size -= len(whole) - len(whole.dictionary)

    def taken(self) -> Iterator[tuple[str, pa.Array, np.ndarray, np.ndarray]]:
        """Language, names, codes and counts of all that is held, which is forgotten."""
        self._merge()
        found, self.held, self.size = self.held, defaultdict(list), 0
        for lang, [(names, codes, n)] in found.items():
            yield lang, names, codes, n


def _added(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes, ascending, and for each the sum of its ``n``."""
    order = np.argsort(codes)
    codes = codes[order]
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    return codes[first], np.add.reduceat(n[order], first) if len(first) else n


def level(rows: DataFrame, length: int, before: int, kept: Bitmap | None, min_docs: int) -> DataFrame:
    """``lang``, ``prefix`` of those prefixes of ``length`` bytes that at least ``min_docs`` documents of the language hold.

    Looks at terms longer than ``before`` bytes whose prefix of that length the bitmap has.
    """

    def meaning(lang: bytes, terms: pa.Array) -> pa.Array:
        """The prefix of this level of terms that the level before neither dropped nor completed."""
        prefixes = pc.binary_slice(pc.binary_join_element_wise(terms, END, b""), 0, length)
        if kept is None:
            return prefixes
        heads = pc.binary_slice(terms, 0, before).dictionary_encode()
        has = kept.has(lang, heads.dictionary.to_numpy(zero_copy_only=False).tolist())[heads.indices.to_numpy()]
        return pc.if_else(pa.array(has), prefixes, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(lambda _: 1)

        def handed_on() -> Iterator[pa.RecordBatch]:
            for lang, prefixes, number, n in counts.taken():
                yield pa.RecordBatch.from_arrays([pa.repeat(lang, len(number)), prefixes.take(pa.array(number)), pa.array(n)], names=["lang", "prefix", "n"])

        for lang, prefixes, numbers, owner, _ in _by_language(batches, before, meaning):
            held = np.sort(owner * len(prefixes) + numbers)
            once = held[np.diff(held, prepend=-1) > 0] % max(len(prefixes), 1)  # a text counts once for a prefix
            if counts.add(lang, prefixes, np.arange(len(prefixes)), np.bincount(once, minlength=len(prefixes))):
                yield from handed_on()
        yield from handed_on()

    counted = rows.select("_text", "lang").mapInArrow(run, "lang string, prefix binary, n bigint")
    return counted.groupBy("lang", "prefix").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_docs).select("lang", "prefix")


def kept_terms(documents: DataFrame, text: str = "text", lang: str = "lang", min_docs: int = MIN_DOCS, first: int = FIRST_LEVEL) -> DataFrame:
    """``lang``, ``term`` (bytes): the terms that at least ``min_docs`` documents of the language hold."""
    rows = _rows(documents, text, lang, lang)
    whole, length, before, kept = None, first, 0, None
    while True:
        found = stored(level(rows, length, before, kept, min_docs), "iceberg")
        complete = F.endswith("prefix", F.lit(END))
        terms = found.filter(complete).select("lang", F.expr("substring(prefix, 1, length(prefix) - 1)").alias("term"))
        whole = terms if whole is None else whole.unionByName(terms)
        still = found.filter(~complete)
        if still.isEmpty():
            return whole
        length, before, kept = 2 * length, length, Bitmap.of(still)


_HELD = "array<struct<place: int, n: bigint>>"


def _lists(lang: pa.Array, term: pa.Array, owner: np.ndarray, place: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Rows of a term with its list of places and counts; ``owner`` is the row of each, ascending."""
    ends = np.cumsum(np.bincount(owner, minlength=len(term)))
    items = pa.StructArray.from_arrays([pa.array(place, pa.int32()), pa.array(n, pa.int64())], names=["place", "n"])
    held = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), items)
    return pa.RecordBatch.from_arrays([lang, term, held], names=["lang", "term", "held"])


def occurrences(rows: DataFrame, terms: DataFrame, places: dict[str, dict[str, int]]) -> DataFrame:
    """``lang``, ``term`` and ``held``, the (place of a source, occurrences) of the sources that have it, for each kept term.

    The bitmap spares the shuffle most other terms, a join all of them.  A task hands
    on a term of a language with its counts in one row, and the rows of a term, which
    come sorted, are added up one after the other: a frequent term is no hot key and no
    list of all its rows is made.
    """
    kept = Bitmap.of(terms.withColumnRenamed("term", "prefix"))

    def meaning(lang: bytes, found: pa.Array) -> pa.Array:
        return pc.if_else(pa.array(kept.has(lang, found.to_numpy(zero_copy_only=False).tolist())), found, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(lambda lang: len(places[lang]))

        def handed_on() -> Iterator[pa.RecordBatch]:
            for lang, found, codes, n in counts.taken():
                yield _lists(pa.repeat(lang, len(found)), found, *np.divmod(codes, len(places[lang])), n)

        for lang, found, numbers, owner, sources in _by_language(batches, 1, meaning):
            place = np.array([places[lang][s] for s in sources], np.int64)
            codes, n = np.unique(numbers * len(places[lang]) + place[owner], return_counts=True)
            if counts.add(lang, found, codes, n):
                yield from handed_on()
        yield from handed_on()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of one term after each other made one; the last term of a batch waits for the next batch."""
        waiting: pa.RecordBatch | None = None
        for batch in batches:
            rows_ = [b for b in (waiting, batch) if b is not None and b.num_rows]
            if not rows_:
                continue
            whole = pa.Table.from_batches(rows_).combine_chunks().to_batches()[0]
            lang, term, held = whole.columns
            fresh = np.ones(len(term), bool)
            fresh[1:] = ~(pc.equal(lang.slice(1), lang.slice(0, len(lang) - 1)).to_numpy(False) & pc.equal(term.slice(1), term.slice(0, len(term) - 1)).to_numpy(False))
            owner = np.repeat(np.cumsum(fresh) - 1, np.diff(held.offsets.to_numpy()))
            items = held.flatten()
            place, n = items.field("place").to_numpy().astype(np.int64), items.field("n").to_numpy()
            width = int(place.max(initial=0)) + 1
            codes, at = np.unique(owner * width + place, return_inverse=True)
            sums = np.zeros(len(codes), np.int64)
            np.add.at(sums, at, n)
            first = pa.array(np.flatnonzero(fresh))
            made = _lists(lang.take(first), term.take(first), codes // width, codes % width, sums)
            yield made.slice(0, made.num_rows - 1)
            waiting = made.slice(made.num_rows - 1)
        if waiting is not None:
            yield waiting

    schema = f"lang string, term binary, held {_HELD}"
    dealt = rows.mapInArrow(run, schema).repartition("lang", "term").sortWithinPartitions("lang", "term")
    return dealt.mapInArrow(add, schema).join(terms, ["lang", "term"], "left_semi")


def shares(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (counts + 2) / whole) in 64 bits: three decimal digits of the quotient at a time."""
    out, rest = np.zeros(1, np.int64), counts + 2
    for _ in range(4):
        digits, left = np.divmod(rest, whole)
        out, rest = out * 1000 + digits, left * 1000
    return out + 1


def pair_sums(by_term: DataFrame, wholes: dict[str, np.ndarray]) -> DataFrame:
    """``lang``, places ``a`` < ``b`` and ``value``: the measure of each pair of sources, summed over all kept terms.

    ``wholes`` holds, for each language, the divisors of its sources by place.  A task
    adds up all its terms in one matrix of a language and returns that once.
    """

    def add(into: np.ndarray, whole: np.ndarray, part: pa.RecordBatch) -> None:
        held = part.column(1)
        row = np.repeat(np.arange(len(held)), np.diff(held.offsets.to_numpy()))
        items = held.flatten()
        counts = np.zeros((len(held), len(whole)), np.int64)
        counts[row, items.field("place").to_numpy()] = items.field("n").to_numpy()
        p = shares(counts, whole)
        for a in range(len(whole) - 1):
            one, rest = p[:, a : a + 1], p[:, a + 1 :]
            into[a, a + 1 :] += ((one - rest) ** 2 // (one + rest)).sum(axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in set(langs):
                whole = wholes[lang]
                into = sums.setdefault(lang, np.zeros((len(whole), len(whole)), np.int64))
                own = batch.filter(pa.array(langs == lang))
                step = max(1, 1_000_000 // len(whole))
                for start in range(0, own.num_rows, step):
                    add(into, whole, own.slice(start, step))
        for lang, into in sums.items():
            a, b = np.triu_indices(len(into), 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(a), pa.string()), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(into[a, b])],
                names=["lang", "a", "b", "value"],
            )

    added = by_term.select("lang", "held").mapInArrow(run, "lang string, a int, b int, value bigint")
    return added.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def _share(count: str, whole: str) -> Column:
    return F.expr(f"1 + (cast({count} + 2 as decimal(20, 0)) * {UNIT}) div {whole}")


_MEASURE = "((p - q) * (p - q)) div (p + q)"


def audit(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = TOP_TERMS,
    first: int = FIRST_LEVEL,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank`` of every group.

    Part ``pair`` has the group's difference from each other source of its language,
    part ``term`` the ``top`` kept terms it has more of than its language.  Both are
    ranked by value, then by item.  Names and sizes of the groups come to the driver; the
    result has a row for each pair of them.
    """
    rows = _rows(documents, text, lang, source)
    terms = stored(kept_terms(documents, text, lang, min_docs, first), "kept-terms")
    in_language = Window.partitionBy("lang").orderBy("source")
    places = rows.select("lang", "source").distinct().withColumn("place", F.row_number().over(in_language) - 1)
    places = stored(places, "sources")
    place_of: dict[str, dict[str, int]] = defaultdict(dict)
    for r in places.collect():
        place_of[r.lang][r.source] = r.place
    by_term = stored(occurrences(rows, terms, dict(place_of)), "term-counts")

    each = by_term.select("lang", "term", F.inline("held"))
    vocabulary = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    groups = places.join(each.groupBy("lang", "place").agg(F.sum("n").alias("n")), ["lang", "place"], "left").join(vocabulary, "lang", "left")
    groups = groups.selectExpr("lang", "source", "place", "coalesce(n, 0L) as n", "coalesce(v, 0L) as v")
    groups = stored(groups.withColumn("whole", F.expr("n + 2 * v")), "source-sizes")
    languages = groups.groupBy("lang").agg((F.sum("n") + 2 * F.max("v")).alias("language_whole"))

    wholes: dict[str, dict[int, int]] = defaultdict(dict)
    for r in groups.filter("v > 0").select("lang", "place", "whole").collect():
        wholes[r.lang][r.place] = r.whole
    sums = pair_sums(by_term, {k: np.array([w for _, w in sorted(g.items())], np.int64) for k, g in wholes.items()})
    one = groups.select("lang", "source", F.col("place").alias("_one"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("_other"))
    pairs = one.join(other, "lang").filter("_one <> _other").withColumns({"a": F.least("_one", "_other"), "b": F.greatest("_one", "_other")})
    pairs = pairs.join(sums, ["lang", "a", "b"], "left").selectExpr("lang", "source", "'pair' as part", "item", "coalesce(value, 0L) as value")

    totals = by_term.withColumn("all", F.expr("aggregate(held, 0L, (sum, h) -> sum + h.n)")).join(languages, "lang")
    with_q = totals.select("lang", "term", _share("all", "language_whole").alias("q"), F.inline("held"))
    with_p = with_q.join(groups.select("lang", "place", "source", "whole"), ["lang", "place"]).withColumn("p", _share("n", "whole"))
    best = with_p.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.decode("term", "UTF-8").alias("item"), F.expr(_MEASURE).alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    ranked = lambda frame: frame.withColumn("rank", F.row_number().over(by_value))
    return ranked(pairs).unionByName(ranked(best).filter(F.col("rank") <= top))
