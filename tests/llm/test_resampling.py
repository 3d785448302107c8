"""Importance resampling against SQL, a plain model and row-by-row draws."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scenarios.compare import difference
from tidelog.llm import queries, resampling

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_features(text, order=2):
    words = _WORD.findall((text or "").translate(_LOWER))
    return words, [" ".join(words[i : i + n]).encode() for n in range(1, order + 1) for i in range(len(words) - n + 1)]


def slow_resample(documents, target, share, min_words, seed, buckets=resampling.BUCKETS):
    """Rows of id, features, weight, score and rank from loops and dictionaries."""
    bucket = lambda f: zlib.crc32(f) % buckets
    s, t = Counter(), Counter()
    for counts, texts in ((s, [d[1] for d in documents]), (t, target)):
        for text in texts:
            counts.update(map(bucket, slow_features(text)[1]))
    raw, wanted = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log(((t[b] + 1) * (raw + buckets)) / ((s[b] + 1) * (wanted + buckets))))
    rows = []
    for id_, text in documents:
        words, found = slow_features(text)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if id_ is None else id_}".encode()).hexdigest()[:8], 16)
        rows.append((id_, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)))
    able = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = [r[:4] for r in able[: share * len(able) // 100]]
    return rows, drawn


def test_query_equals_sql(spark, sf_dir, duck):
    assert difference(queries.op11_resampling(spark, sf_dir), duck, queries.ORACLES["op11_resampling"]) == ""


def test_whole_draw_against_loops(spark, documents):
    docs = spark.createDataFrame(documents, "doc_id long, text string").repartition(5)
    target = [t for _, t in documents[:7]]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(docs, frame, share=40, min_words=5, seed=3).collect()
    rows, drawn = slow_resample(documents, target, 40, 5, 3)
    assert sorted(tuple(r)[:4] for r in got) == sorted(r[:4] for r in rows)
    assert [tuple(r)[:4] for r in sorted((r for r in got if r.rank), key=lambda r: r.rank)] == drawn
    assert sorted(r.rank for r in got if r.rank) == list(range(1, len(drawn) + 1))


def test_draw_moves_towards_the_target(spark, documents):
    """A target of one language draws that language more often than its share, by more than chance."""
    docs = [(i, t) for i, t in documents if t and len(t.split()) >= 20]
    like = {i for i, t in docs if " los " in t}
    target = spark.createDataFrame([(t,) for i, t in docs if i in like], "text string")
    got = resampling.resample(spark.createDataFrame(docs, "doc_id long, text string"), target).filter("rank is not null").collect()
    drawn, base = sum(r.doc_id in like for r in got), len(like) / len(docs)
    assert 0.05 < base < 0.5 and drawn > len(got) * base + 2 * (len(got) * base * (1 - base)) ** 0.5


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"ab", b"x" * 32, b"x" * 33, b"x" * 33 + b"y", b"x" * 33 + b"z", "é".encode(), b"q" * 500]), max_size=80), st.integers(1, 50))
def test_interning_against_a_dictionary(features, buckets):
    table = resampling.Interned(features, buckets)
    assert len(set(table.place.tolist())) == len(set(features))
    assert all((table.place[i] == table.place[j]) == (features[i] == features[j]) for i in range(len(features)) for j in range(i))
    assert [int(b) for b in table.bucket[table.place]] == [zlib.crc32(f) % buckets for f in features]
    assert [int(n) for n in table.count[table.place]] == [features.count(f) for f in features] and table.count.sum() == len(features)


def test_equal_hashes_are_told_apart_by_bytes(monkeypatch):
    """With one hash for all features only the bytes decide."""
    monkeypatch.setattr(resampling.xxhash, "xxh64_intdigest", lambda f: 12345)
    features = [f"f{i % 40}".encode() + b"x" * (i % 40) for i in range(200)]
    table = resampling.Interned(features)
    assert len(set(table.place.tolist())) == 40 and all(table.count[table.place] == 5)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_pieces_lose_no_run(order):
    """Runs across the pieces of a long text, words longer than a piece included."""
    rng = np.random.default_rng(order)
    text = " ".join("w" * int(n) + str(n) for n in rng.integers(1, 40, 300)) + "!? é中 "
    whole = Counter(resampling.runs(text.encode().translate(resampling._WORDS).split(), [], order))
    for size in (5, 30, 400):
        found, before = Counter(), []
        for words in resampling.pieces(text.encode(), size):
            found.update(resampling.runs(words, before, order))
            before = (before + words)[1 - order :] if order > 1 else []
        assert found == whole
    assert whole == Counter(slow_features(text, order)[1])


def test_ranks_of_equal_rows_over_several_ranges(spark):
    """A third of the rows are one row; ranks stay whole and in order."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(i % 17, i) for i in range(600)] + [(5, 7)] * 300
        frame = spark.createDataFrame(rows, "_score int, _id int").repartition(4)
        got = sorted(resampling.ranked(frame, [F.col("_score").desc(), F.col("_id")]).collect(), key=lambda r: r._rank)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r._rank for r in got] == list(range(1, 901))
    assert [(r._score, r._id) for r in got] == sorted(rows, key=lambda r: (-r[0], r[1]))


def test_edges(spark, odd, none):
    target = spark.createDataFrame([("alpha1 beta1",), (None,)], "text string")
    got = resampling.resample(odd, target, share=100, min_words=1).collect()
    assert len(got) == odd.count() and got[0].__fields__ == ["doc_id", "n_features", "weight", "score", "rank"]
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[2][0].n_features == by_id[3][0].n_features == by_id[5][0].n_features == 0 and by_id[2][0].weight == 0 and by_id[2][0].rank is None
    assert by_id[6][0].n_features == 1 and by_id[7][0].n_features == 3 and by_id[4][0].n_features == 239_999
    assert by_id[1][0][:4] == by_id[1][1][:4] and abs(by_id[1][0].rank - by_id[1][1].rank) == 1
    assert sorted(r.rank for r in got if r.rank) == list(range(1, sum(r.n_features > 0 for r in got) + 1))
    assert resampling.resample(none, target).count() == 0
    assert resampling.resample(odd, spark.createDataFrame([], "text string")).count() == odd.count()


def test_clashing_names_and_bad_bytes(spark):
    frame = spark.sql("select 1L as doc_id, cast(unhex('41FF62') as string) as text, 'x' as _id, 'x' as _text, 'x' as rank, 'x' as score, 'x' as weight, 'x' as _row, 'x' as bucket")
    row = resampling.resample(frame, frame.select("text", "bucket")).collect()
    assert [r.n_features for r in row] == [1] and row[0].doc_id == 1
