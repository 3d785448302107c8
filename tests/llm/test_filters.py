"""URL filter, label model and classifier."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from scenarios.compare import difference
from tidelog.llm import quality_classifier as classifier
from tidelog.llm import quality_rules as rules
from tidelog.llm import queries, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_url_query_equals_sql(spark, sf_dir, duck):
    assert difference(queries.op1_url_filter(spark, sf_dir), duck, queries.ORACLES["op1_url_filter"]) == ""


def expected_verdict(url, listed):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        (len(h + p), len(h), v, h + p) for h, p, v in listed
        if host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def test_url_edges(spark):
    listed = [("com", "/", "allow"), ("a.com", "/x", "block"), ("a.com", "/x", "allow"), ("b.a.com", "", "block"), ("org", "/p/q/", "block")]
    urls = [
        None, "", "a.com/x", "http://", "http://A.COM/xyz", "http://b.a.com", "http://c.b.a.com/?q=://z/x", "http://xa.com/x", "https://a.com#/x",
        "http://z.org/p/q/r?x", "http://z.org/p/q", "ftp://É.com/x", "http://a.com:80/x", "http://.com/x", "http://a.com./x", "http://a.com/x",
    ]
    pages = spark.createDataFrame([(i, u, "e") for i, u in enumerate(urls)] + [(0, None, "e"), (None, urls[4], "e")], "page_id int, url string, rule string")
    got = url_filter.judged(pages, spark.createDataFrame(listed, "host string, path string, verdict string"), keep=["page_id"]).collect()
    want = [(i, *expected_verdict(u, listed)) for i, u in enumerate(urls)] + [(0, "", "", None, "allow"), (None, *expected_verdict(urls[4], listed))]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    nothing = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in url_filter.judged(pages, nothing).collect()} == {"allow"}
    assert url_filter.judged(pages.limit(0), nothing).count() == 0


def test_bloom_never_misses_and_join_removes_false_hits(spark):
    listed = spark.range(3000).selectExpr("concat('h', id, '.net') host", "'/a' path", "'block' verdict")
    pages = spark.range(6000).selectExpr("id page_id", "concat('http://h', id, '.net/a/b') url")
    got = {r.page_id for r in url_filter.judged(pages, listed, keep=["page_id"]).filter("verdict = 'block'").collect()}
    assert got == set(range(3000))


def base_counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def test_rules_base_equals_brute_force(spark, sf_dir, documents):
    got = {r.doc_id: r for r in queries.op5_quality_rules(spark, sf_dir).collect()}
    assert len(got) == len(documents)
    for doc_id, text in documents:
        r = got[doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_counts(text)
        assert r.kept == (not r.base_failed and r.p_good >= 0.5)


def test_repeated_windows_are_compared_as_words():
    for text in ("a b c a b c", "a a a a", "a b", "", "a b c d a b c", "x y z " * 9 + "end"):
        assert rules.repeated_words(text.encode().split()) == base_counts(text)[4]


def test_label_model_against_one_document_at_a_time(documents):
    """Estimation over pattern counts equals estimation over single documents."""
    cast = rules.votes(rules.stats([(t or "").encode() for _, t in documents]))
    codes = rules.patterns(cast)
    values, counts = np.unique(codes, return_counts=True)
    model, single = rules.fit_counts(values.tolist(), counts.tolist()), rules.fit_counts(codes.tolist(), [1] * len(codes))
    assert np.allclose(model.posterior(codes), single.posterior(codes), atol=1e-6)


def test_label_model_learns_which_rules_are_right():
    """Two rules agree with the truth, one is a coin: its votes must count less."""
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.9
    cast = np.zeros((4000, len(rules.RULES)), np.int8)
    for r, right in ((0, 0.97), (1, 0.97), (2, 0.97), (3, 0.55)):
        cast[:, r] = np.where(rng.random(4000) < right, np.where(truth, 1, -1), np.where(truth, -1, 1))
    values, counts = np.unique(rules.patterns(cast), return_counts=True)
    model = rules.fit_counts(values.tolist(), counts.tolist())
    assert min(a[0] for a in model.accuracies[:3]) > model.accuracies[3][0] + 0.1
    kept = model.posterior(rules.patterns(cast)) >= 0.5
    assert (kept == truth).mean() > 0.97


def test_rules_agree_with_labels(spark):
    """Held against labels, which the rules never see: bad ones go, good ones that pass the base check stay."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = queries.op5_quality_rules(spark, folder).join(labels, "doc_id").select("base_failed", "kept", "quality").collect()
    good = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r.kept for r in rows if r.quality == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.05


def test_rules_edges(odd, none):
    judged = rules.judge(odd, keep=["doc_id"])
    assert judged.count() == odd.count()
    by_id = {}
    for r in judged.collect():
        by_id.setdefault(r.doc_id, []).append(r)
    assert all(r.base_failed and not r.kept for i in (2, 3, 5, 6, 7) for r in by_id[i])
    assert by_id[1][0] == by_id[1][1] and by_id[4][0].n_words == 120_000
    kept = rules.keep_good(odd)
    assert kept.schema == odd.schema and kept.filter("doc_id = 1").count() == 2 * by_id[1][0].kept
    assert rules.judge(none, keep=["doc_id"]).count() == 0 and rules.keep_good(none).count() == 0


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = queries.op10_quality_classifier(spark, folder)
    rows = scored.join(labels, "doc_id").collect()
    assert scored.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(r.score, r.quality) for r in rows if r.held_out]
    assert np.mean([(s >= 0.3) == bool(q) for s, q in held]) >= 0.95
    good, bad = [s for s, q in held if q == 1], [s for s, q in held if q == 0]
    assert np.mean([g > b for g in good for b in bad]) >= 0.95


def test_scoring_by_words_equals_the_average_of_vectors():
    rng = np.random.default_rng(2)
    model = classifier.Classifier(rng.normal(size=(classifier.BUCKETS, classifier.DIMENSIONS)), rng.normal(size=(2, classifier.DIMENSIONS)), rng.normal(size=2))
    scorer = classifier.Scorer(*model.word_logits())
    for text in (b"", b"a", b"hello world hello hello", "é中 x".encode() * 20):
        ids, shares = classifier.bag(text)
        logits = model.layer @ (shares @ model.vectors[ids] if len(ids) else np.zeros(classifier.DIMENSIONS)) + model.bias
        assert scorer.score(text) == pytest.approx(1 / (1 + np.exp(logits[0] - logits[1])), abs=1e-6)


def slow_buckets(word):
    """The word and its character n-grams, cut from the decoded word."""
    marked = f"<{word}>"
    grams = [(n, marked[i : i + n]) for n in classifier.NGRAMS for i in range(len(marked) - n + 1)]
    return [zlib.crc32(word.encode()) % classifier.BUCKETS] + [zlib.crc32(g.encode(), n) % classifier.BUCKETS for n, g in grams]


def test_ngrams_are_of_characters(monkeypatch):
    words = ["a", "plain", "été", "Привет", "中文", "🙂", "naïve🙂x", "x" * 50 + "é" * 50]
    for run in (1 << 16, 7):
        monkeypatch.setattr(classifier, "_RUN", run)
        for word in words:
            assert sorted(b for part in classifier.subwords(word.encode()) for b in part) == sorted(slow_buckets(word))


def test_gradients_are_those_of_the_weighted_loss():
    rng = np.random.default_rng(3)
    model = classifier.Classifier(rng.normal(size=(classifier.BUCKETS, classifier.DIMENSIONS)), rng.normal(size=(2, classifier.DIMENSIONS)), rng.normal(size=2))
    bags = [classifier.bag(t) for t in (b"some plain words", "été à Paris".encode(), b"", b"words words again")]
    target, weight = np.array([1, 0, 1, 0]), np.array([0.5, 2.0, 1.0, 1.5])

    def loss():
        out = 0.0
        for (ids, shares), t, w in zip(bags, target, weight):
            logits = model.layer @ (shares @ model.vectors[ids] if len(ids) else np.zeros(classifier.DIMENSIONS)) + model.bias
            out -= w * (logits[t] - np.log(np.exp(logits).sum()))
        return out

    layer, bias, touched, vectors = classifier.gradients(model, bags, target, weight)
    assert set(touched) == {int(i) for ids, _ in bags for i in ids}
    for array, at, got in [(model.layer, (1, 3), layer[1, 3]), (model.bias, (0,), bias[0]), (model.vectors, (touched[5], 2), vectors[5, 2]), (model.vectors, (touched[-1], 0), vectors[-1, 0])]:
        array[at] += 1e-6
        high = loss()
        array[at] -= 2e-6
        assert (high - loss()) / 2e-6 == pytest.approx(got, rel=1e-4, abs=1e-8)
        array[at] += 1e-6


def test_training_against_a_loop_over_documents():
    """The same steps, one document and one bucket at a time."""
    texts = [b"good plain words here", b"bad bad bad", "des mots français".encode(), b"bad again and again", b"good words"] * 9
    labels, weights = [int(not t.startswith(b"bad")) for t in texts], [1.0 + i % 3 for i in range(len(texts))]
    bags = [classifier.bag(t) for t in texts]
    got = classifier.train(bags, labels, weights, seed=5)
    rng = np.random.default_rng(5)
    vectors = rng.uniform(-1 / classifier.DIMENSIONS, 1 / classifier.DIMENSIONS, (classifier.BUCKETS, classifier.DIMENSIONS))
    share = (np.dot(weights, labels) / sum(weights) * len(bags) + 0.5) / (len(bags) + 1)
    bias, layer = np.log([1 - share, share]), rng.normal(0, 0.1, (2, classifier.DIMENSIONS))
    batches = -(-len(bags) // classifier.BATCH)
    for epoch in range(classifier.EPOCHS):
        order = rng.permutation(len(bags))
        for k in range(batches):
            rate = classifier.RATE * (1 - (epoch * batches + k) / (classifier.EPOCHS * batches))
            d_layer, d_bias, d_vectors = np.zeros_like(layer), np.zeros(2), {}
            for i in order[k * classifier.BATCH : (k + 1) * classifier.BATCH]:
                average = sum(s * vectors[b] for b, s in zip(*bags[i]))
                p = np.exp(layer @ average + bias)
                p = p / p.sum()
                p[labels[i]] -= 1
                p *= weights[i]
                d_layer += np.outer(p, average)
                d_bias += p
                for b, s in zip(*bags[i]):
                    d_vectors[b] = d_vectors.get(b, 0) + s * (p @ layer)
            layer, bias = layer - rate * classifier.LAYER_RATE * d_layer, bias - rate * classifier.BIAS_RATE * d_bias
            for b, d in d_vectors.items():
                vectors[b] -= rate * classifier.VECTOR_RATE * d
    assert np.allclose(got.vectors, vectors, atol=1e-5) and np.allclose(got.layer, layer, atol=1e-5) and np.allclose(got.bias, bias, atol=1e-5)


def test_labels_of_the_held_out_fold_are_never_read(spark, sf_dir):
    """Turning every held-out label round changes no score."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    turned = labels.withColumn("quality", F.when(classifier.training_rows(), labels.quality).otherwise(1 - labels.quality))
    a, b = (classifier.fit(documents, x, "quality", classifier.training_rows()) for x in (labels, turned))
    assert np.array_equal(a.vectors, b.vectors) and np.array_equal(a.bias, b.bias)


def test_long_words_are_read_whole(monkeypatch):
    word = bytes(97 + (i * i + i // 7) % 26 for i in range(500))
    marked = b"<" + word + b">"
    want = [zlib.crc32(word) % classifier.BUCKETS]
    want += [zlib.crc32(marked[i : i + n], n) % classifier.BUCKETS for n in classifier.NGRAMS for i in range(len(marked) - n + 1)]
    assert [b for run in classifier.subwords(word) for b in run] == want
    for size in (1, 3, 499, 500, 501, 502):
        monkeypatch.setattr(classifier, "_RUN", size)
        runs = list(classifier.subwords(word))
        assert sorted(b for run in runs for b in run) == sorted(want) and len(runs) == -(-502 // size)
        assert list(classifier.subwords(b"")) != []
    logits = np.random.default_rng(3).normal(size=classifier.BUCKETS)
    scorer = classifier.Scorer(logits, 0.5)
    odds = 0.5 + logits[want].mean()
    assert scorer.score(word) == pytest.approx(1 / (1 + np.exp(-odds)))
    assert scorer.place == {} and scorer.score(b"short") and list(scorer.place) == [b"short"]


def test_classifier_edges(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (6, 0), (8, 0), (8, 0), (None, 1), (4, None), (7, 5)], "doc_id bigint, quality int")
    model = classifier.fit(odd, labels, "quality", "true")
    scored = classifier.score(odd, model, keep=["doc_id"])
    rows = scored.collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    empties = {r.score for r in rows if r.doc_id in (2, 3, 5)}
    assert len(empties) == 1
    assert classifier.accept(odd, model).schema == odd.schema
    assert classifier.score(none, classifier.fit(none, labels.limit(0), "quality", "true")).count() == 0
    one_sided = classifier.fit(odd, labels.filter("quality = 1"), "quality", "true")
    assert all(r.score > 0.5 for r in classifier.score(odd, one_sided).collect())
