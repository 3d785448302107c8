"""Fingerprints and near copies against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidelog.llm import queries, simhash, sketch
from tidelog.llm.common import words_of
from tidelog.llm.components import components


def shingle_set(text, size=sketch.SHINGLE):
    words = words_of((text or "").encode(), lower=True)
    n = min(size, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def test_fingerprint_query_against_brute_force(spark, sf_dir, documents):
    got = {r.doc_id: r for r in queries.op3_fingerprints(spark, sf_dir).collect()}
    assert len(got) == len(documents)
    maker = sketch.Sketcher()
    errors = []
    for (doc_id, text), (_, following) in zip(documents, [*documents[1:], documents[0]]):
        text, following = text or "", following or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        r = got[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.fingerprint == sketch.packed(maker.sketch(text.encode())).hex()
        assert r.edited_fingerprint == sketch.packed(maker.sketch(changed.encode())).hex()
        mine, other, nexts = shingle_set(text), shingle_set(changed), shingle_set(following)
        errors += [r.near_edited - jaccard(mine, other), r.near_next - jaccard(mine, nexts)]
        if len(mine) < sketch.K:
            assert r.n_shingles == len(mine)
        else:
            assert 0.6 < r.n_shingles / len(mine) < 1.6
        if len(mine | other) <= sketch.K:
            assert r.near_edited == pytest.approx(jaccard(mine, other))
        within = len(mine & other) / len(mine) if mine else 1.0
        assert abs(r.contained_in_edited - within) < 0.25
    assert max(map(abs, errors)) < 0.2 and abs(np.mean(errors)) < 0.01


def test_successor_crosses_blocks(spark):
    """Blocks of a few rows give the same successors as one block."""
    docs = spark.createDataFrame([(i * 3 % 101, f"text {i} of many words here and there {i * i}") for i in range(101)], "doc_id long, text string").repartition(7)
    rows = sketch.with_next(docs, "text", "doc_id", block_rows=4).collect()
    assert len({r._block for r in rows}) > 10
    got = {r.doc_id: r.edited_text for r in sketch.with_successor(docs).collect()}
    texts = dict(sorted((r.doc_id, r.text) for r in docs.collect()))
    ids = list(texts)
    assert got == {i: sketch.edited(texts[i], texts[ids[(k + 1) % len(ids)]]) for k, i in enumerate(ids)}
    few = {}
    for r in sorted(rows, key=lambda r: (r._block, r._border, r._id)):
        few.setdefault(r._block, []).append(r._id)
    follows = {a: b for ids_ in few.values() for a, b in zip(ids_, ids_[1:])}
    assert follows == {i: ids[(k + 1) % len(ids)] for k, i in enumerate(ids)}


def test_sketches_merge(spark, documents):
    maker = sketch.Sketcher()
    texts = [(t or "").encode() for _, t in documents]
    # shingles of a joined text that cross the joint belong to neither part, so merge shingle sets of whole texts
    parts = [maker.sketch(t) for t in texts]
    union = set().union(*(shingle_set(t) for _, t in documents))
    whole = sketch.merge(parts)
    assert sketch.merge([sketch.merge(parts[::2]), sketch.merge(parts[1::2])]).tolist() == whole.tolist()
    assert 0.75 < sketch.distinct(whole) / len(union) < 1.3
    frame = spark.createDataFrame([(i % 3 if i % 5 else None, t.decode()) for i, t in enumerate(texts)], "part int, text string")
    merged = sketch.merged_by(sketch.sketches(frame, keep=["part"]).repartition(5), "part").collect()
    want = {p: sketch.packed(sketch.merge([parts[i] for i in range(len(texts)) if (i % 3 if i % 5 else None) == p])) for p in (0, 1, 2, None)}
    assert {r.part: bytes(r.sketch) for r in merged} == want


def test_smallest_is_exact_where_values_repeat():
    rng = np.random.default_rng(3)
    for values in (rng.integers(0, 50, 5000), np.zeros(5000, int), rng.integers(0, 1 << 60, 5000), np.repeat(rng.integers(0, 1 << 60, 200), 40)):
        values = values.astype(np.uint64)
        assert sketch.smallest(values, 128).tolist() == sorted(set(values.tolist()))[:128]


def test_sketch_edges(odd, none):
    rows = sketch.with_successor(odd).collect()
    assert len(rows) == odd.count()
    assert len({bytes(r.sketch) for r in rows if r.doc_id == 1}) == 1
    empty = [r for r in rows if r.n_chars == 0]
    assert empty and all(bytes(r.sketch) == b"" and r.edited_text == "" and r.near_edited == 1.0 for r in empty)
    assert sketch.with_successor(none).count() == 0
    assert sketch.sketches(none, keep=["doc_id"]).count() == 0


def slow_fingerprint(text):
    words = words_of((text or "").encode(), lower=True)
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)]
    ones = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        ones.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b, n in ones.items() if 2 * n > len(shingles))


def slow_components(values, radius):
    label = list(range(len(values)))

    def root(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(values))]


def test_simhash_query_against_brute_force(spark, sf_dir, documents):
    got = {r.doc_id: r for r in queries.op7_simhash(spark, sf_dir).collect()}
    values = [slow_fingerprint(t) for _, t in documents]
    roots = slow_components(values, 2)
    first = {}
    for (doc_id, _), r in zip(documents, roots):
        first[r] = min(first.get(r, doc_id), doc_id)
    assert len(got) == len(documents)
    for (doc_id, _), value, r in zip(documents, values, roots):
        assert got[doc_id].fingerprint == f"{value:016x}" and got[doc_id].component_id == first[r]
    assert len(set(first)) < len(documents)


def test_hashes_are_those_of_spark(spark):
    text = "Der große Käse"
    row = spark.createDataFrame([("der große käse",)], "s string").select(F.xxhash64("s").alias("h")).first()
    assert simhash.fingerprint(text.encode()) == row.h % (1 << 64) == xxhash.xxh64_intdigest("der große käse".encode(), 42)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_sliced_links_against_brute_force(spark, radius, monkeypatch):
    """Dense clusters around centres, chains of near values, zero, and buckets that are divided again."""
    rng = np.random.default_rng(radius)
    values = {0, 1, 3, 7, (1 << 64) - 1}
    for centre in rng.integers(0, 1 << 63, 8, dtype=np.uint64).tolist():
        for _ in range(40):
            changed = centre
            for bit in rng.integers(0, 64, rng.integers(0, 4)).tolist():
                changed ^= 1 << bit
            values.add(changed)
    values = np.array(sorted(values), np.uint64)
    want = slow_components(values.tolist(), radius)
    assert simhash.forest(values, radius, 0).tolist() == want
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long").repartition(4)
    monkeypatch.setattr(simhash, "_LARGE", 50)
    assert simhash.forest(values, radius, 0).tolist() == want
    found = {r.node: r.root for r in components(simhash.links(frame, radius)).collect()}
    names = [int(v) for v in values.view(np.int64)]
    groups = [found.get(v, v) for v in names]
    assert len(set(groups)) == len(set(want)) and len(set(zip(groups, want))) == len(set(want))


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1300)] + [(5000, 4000), (4000, 5000), (7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(found) == set(range(301)) | set(range(1000, 1300)) | {4000, 5000}
    assert all(r == (0 if n < 1000 else 1000 if n < 4000 else 4000) for n, r in found.items())


def test_simhash_edges(odd, none):
    rows = simhash.groups(odd).collect()
    assert len(rows) == odd.count()
    assert {r.fp for r in rows if r.doc_id in (2, 3, 5)} == {0}
    assert {r.component_id for r in rows if r.fp == 0} == {2}
    kept = simhash.one_of_each(odd)
    assert kept.schema == odd.schema
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len({r.root for r in rows}) and ids.count(1) == 1 and ids.count(8) == 2 and ids.count(None) == 0
    assert simhash.groups(none).count() == 0 and simhash.one_of_each(none).count() == 0
    nulls = odd.filter("doc_id is null")
    assert {r.component_id for r in simhash.groups(nulls).collect()} == {None} and simhash.one_of_each(nulls).count() == 2
