"""The source audit against SQL, and its parts against loops over exact integers."""

from __future__ import annotations

import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scenarios.compare import difference
from tidelog.llm import divergence, queries

_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_kept(rows, min_docs):
    docs = Counter()
    for text, lang in rows:
        docs.update({(lang or "", t) for t in _TERM.findall((text or "").translate(_LOWER))})
    return {k for k, n in docs.items() if n >= min_docs}


def slow_audit(rows, min_docs, top):
    """rows of (text, lang, source)."""
    kept = slow_kept([r[:2] for r in rows], min_docs)
    counts, groups = defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for t in _TERM.findall((text or "").translate(_LOWER)):
            if (lang, t) in kept:
                counts[lang, source][t] += 1
                counts[(lang,)][t] += 1
    out = set()
    for lang, source in groups:
        terms = sorted(t for k, t in kept if k == lang)
        share = lambda key, t: 1 + 10**9 * (counts[key][t] + 2) // (counts[key].total() + 2 * len(terms))
        f = lambda p, q: (p - q) ** 2 // (p + q)
        pairs = [(sum(f(share((lang, source), t), share((lang, o), t)) for t in terms), o) for k, o in groups if k == lang and o != source]
        own = [(f(share((lang, source), t), share((lang,), t)), t) for t in terms if counts[lang, source][t] and share((lang, source), t) > share((lang,), t)]
        for part, found in (("pair", pairs), ("term", own)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out |= {(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(found) if part == "pair" or i < top}
    return out


def test_query_equals_sql(spark, sf_dir, duck):
    assert difference(queries.op12_divergence(spark, sf_dir), duck, queries.ORACLES["op12_divergence"]) == ""


TEXTS = [
    "the theatre thesis theses them", "The THEM thé thémis", "a ab abc abcd abcde abcdef abcdefg abcdefgh abcdefghi", "x" * 70 + " " + "x" * 69,
    "theatre, theatre; them\tthe\x00a", "", None, "abcd abcdabcd abcdabcdabcdabcdabcd", "çà et là 中文 中", "9 8 7 _ -",
]


@pytest.mark.parametrize("first", [1, 3, 4, 16])
def test_refinement_keeps_the_frequent_terms(spark, first):
    """Terms that begin others, terms as long as a level and longer, cut characters."""
    rng = np.random.default_rng(first)
    rows = [(TEXTS[i], lang) for i, lang in zip(rng.integers(0, len(TEXTS), 120).tolist(), rng.choice(["en", "de", None], 120).tolist())]
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    for min_docs in (1, 4, 9):
        got = {(r.lang, bytes(r.term).decode()) for r in divergence.kept_terms(frame, min_docs=min_docs, first=first).collect()}
        assert got == slow_kept(rows, min_docs)


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    """One word of 64 bits passes nearly all; every level counts exactly."""
    monkeypatch.setattr(divergence, "MAX_WORDS", 1)
    rows = [(TEXTS[i % len(TEXTS)], "en", f"s{i % 3}") for i in range(60)]
    frame = spark.createDataFrame(rows, "text string, lang string, source string")
    assert {tuple(r) for r in divergence.audit(frame, min_docs=5, top=4).collect()} == slow_audit(rows, 5, 4)


def test_few_held_entries_change_nothing(spark, monkeypatch):
    """Tasks that hand on their counts after every few terms."""
    monkeypatch.setattr(divergence, "HELD_ENTRIES", 2)
    monkeypatch.setattr("tidelog.llm.common.BATCH_ROWS", 3)
    rows = [(TEXTS[i % 9], ("en", "de", None)[i % 2], f"s{i % 4}") for i in range(90)]
    frame = spark.createDataFrame(rows, "text string, lang string, source string")
    assert {tuple(r) for r in divergence.audit(frame, min_docs=3, top=4).collect()} == slow_audit(rows, 3, 4)


def test_python_meets_each_distinct_term_of_a_part_once():
    """200,000 occurrences of 182 terms make no object each, at any level."""
    texts = [" ".join(f"term{chr(97 + i % 26)}{'x' * (i % 7)}" for i in range(k, k + 1000)).upper() for k in range(200)]
    batch = pa.record_batch([pa.array([t.encode() for t in texts]), pa.array(["en"] * 200)], names=["_text", "lang"])
    for shortest in (1, 8):
        met, before = [], sys.getallocatedblocks()

        def meaning(lang, terms):
            assert lang == b"en" and sys.getallocatedblocks() - before < 20_000
            met.append(terms.to_pylist())
            return terms

        [(lang, names, numbers, owner, keys)] = divergence._by_language(iter([batch]), shortest, meaning)
        want = [[w for w in t.lower().encode().split() if len(w) >= shortest] for t in texts]
        assert lang == "en" and keys == ["en"] * 200
        assert sorted(met[0]) == sorted({w for ws in want for w in ws}) and len(met) == 1
        names = names.to_pylist()
        assert [(o, names[n]) for o, n in zip(owner.tolist(), numbers.tolist())] == [(i, w) for i, ws in enumerate(want) for w in ws]


def test_counts_of_parts_add_up(monkeypatch):
    """Parts with other numbers for the same names, with none, and counts handed on in between."""
    rng = np.random.default_rng(2)
    for held in (1, 7, 1000):
        monkeypatch.setattr(divergence, "HELD_ENTRIES", held)
        counts, want, got, width = divergence._Counts({"en": 3, "": 1}.get), Counter(), Counter(), {"en": 3, "": 1}

        def take():
            for lang, names, codes, n in counts.taken():
                assert (np.diff(codes) > 0).all()
                got.update({(lang, names[c // width[lang]].as_py(), c % width[lang]): k for c, k in zip(codes.tolist(), n.tolist())})

        for i in range(40):
            lang = ("en", "")[i % 2]
            names = [b"n%d" % k for k in rng.permutation(12)[: i % 9]]
            codes = np.sort(rng.permutation(len(names) * width[lang])[: 2 * len(names)])
            n = rng.integers(1, 5, len(codes))
            want.update({(lang, names[c // width[lang]], c % width[lang]): k for c, k in zip(codes.tolist(), n.tolist())})
            if counts.add(lang, pa.array(names, pa.binary()), codes, n):
                take()
        take()
        assert got == want and not list(counts.taken())


def test_hash_equals_the_one_of_sql(spark):
    kept = spark.createDataFrame([("en", b"theat"), ("", b"\xc3"), ("dé", b"abc")], "lang string, prefix binary")
    bitmap = divergence.Bitmap.of(kept)
    assert all(bitmap.has(r.lang.encode(), [bytes(r.prefix)])[0] for r in kept.collect())
    assert bitmap.has(b"en", [b"%d" % i for i in range(1000)]).sum() < 100


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 8 * 10**15), st.integers(2, 8 * 10**15))
def test_shares_are_exact(count, more):
    """A count and two are never more than what they are a share of."""
    whole = max(count + 2, more)
    assert int(divergence.shares(np.array([count]), np.array([whole]))[0]) == 1 + 10**9 * (count + 2) // whole


def test_audit_against_loops(spark):
    """Groups without terms, a language without kept terms, null languages and sources, more top terms than there are."""
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abé"), rng.integers(1, 9))) for _ in range(60)]
    rows = [(" ".join(rng.choice(words, rng.integers(0, 30))), "en" if i % 3 else None, f"s{i % 7}") for i in range(200)]
    rows += [("", "en", "silent"), (None, "en", None), ("rare words here", "fr", "a"), (None, "fr", "b"), ("only", "es", "alone")]
    frame = spark.createDataFrame(rows, "text string, lang string, source string").repartition(4)
    got = divergence.audit(frame, top=6).collect()
    assert {tuple(r) for r in got} == slow_audit(rows, 10, 6) and len(got) == len({tuple(r) for r in got})


def test_edges(spark, odd, none):
    rows = [(r.text, r.lang, r.source) for r in odd.select("text", "lang", "source").collect()]
    assert {tuple(r) for r in divergence.audit(odd, min_docs=2).collect()} == slow_audit(rows, 2, 10)
    assert divergence.audit(none).collect() == []
    clashing = none.select("text", "lang", "source", F.lit("x").alias("term"), F.lit("x").alias("place"), F.lit("x").alias("n"), F.lit("x").alias("_text"))
    assert divergence.audit(clashing).columns == ["lang", "source", "part", "item", "value", "rank"]
    bad = spark.sql("select cast(unhex('61FF62') as string) as text, 'en' as lang, 's' as source from range(12)")
    assert [(r.term, r.lang) for r in divergence.kept_terms(bad).collect()] == [(bytearray(b"a\xffb"), "en")]
