"""Extraction, encoding, files and the language model against brute force and the public libraries."""

from __future__ import annotations

import base64
import hashlib
import html
import itertools
import random
import re
import sys
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from tests.llm.conftest import rows_of_table
from tidelog.llm import byte_bpe, gated_lm, html_text, queries, token_files
from tidelog.llm.common import split_words, words_of
from tidelog.workspace import new_dir

RANKS = public_tokenizers.path(queries.BPE_RANKS)


def article(page):
    """The article of a page by its known layout: headline and paragraphs inside <article>."""
    inner = page.split("<article>")[1].split("</article>")[0]
    blocks = (" ".join(html.unescape(re.sub(r"</?b>", "", b).replace("<br>", " ")).split()) for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(filter(None, blocks))


def test_html_query_against_known_layout(spark, sf_dir):
    got = {r.page_id: r for r in queries.op6_html_text(spark, sf_dir).collect()}
    pages = rows_of_table("pages", "page_id, url, html")
    assert len(got) == len(pages)
    for page_id, url, page in pages:
        assert got[page_id].text == article(page) and got[page_id].n_chars == len(article(page)) and got[page_id].url == url


LAYOUT = """<!doctype html><html><head><title>t</title><style>p{}</style></head><body>
<header class="site-header"><h1>Site name</h1><p>A tagline that goes on and on for quite a number of words, as taglines do.</p></header>
<ul class="menu"><li><a href=/a>Home</a><li><a href=/b>News</a></ul>
<div id="cookie-notice"><p>We use cookies to give you the best experience that we can; please accept all of them.</p><button>OK</button></div>
<div class="wrap"><div class="sidebar"><p>Read these other pieces of ours which you may like as well, dear reader.</p></div>
<div class="post-content"><h2>The   title</h2><p>First &amp; <a href=x>linked</a> text,<br>broken.</p><p>Yes.</p>
<ul><li>one</li><li>two&nbsp;items</li></ul><form action=x><label>Your mail address, please</label><input></form>
<div class="ad">Buy this good product now and get another for free, today only, hurry!</div>
<table><tr><td>a</td><td>b &lt; c</td></tr></table><pre>code  x</pre><script>if (a < b) { x = "</p><p>no" }</script><!-- <p>no</p> --><p>Last</div>
<section id="comments"><h3>Comments</h3><article><p>I think that this is a long reader comment with more than enough words in it.</p></article></section>
</div><footer>&copy; 2024 Us</footer></body></html>"""


def test_html_layouts():
    assert html_text.main_text(LAYOUT).split("\n") == ["The title", "First & linked text, broken.", "Yes.", "one", "two items", "a", "b < c", "code x", "Last"]
    assert html_text.main_text("") == ""
    assert html_text.main_text("only words, no markup") == "only words, no markup"
    assert html_text.main_text("<article><p>x &lt;p&gt; y&#233;</p></article") == "x <p> yé"
    assert html_text.main_text("<p>cut <b") == "cut"
    assert html_text.main_text("<script>never closed <p>x</p>") == ""
    assert html_text.main_text("<p>a<p>b<div>c</p>d") == "a\nb\nc\nd"


def test_html_raw_elements_end_at_their_own_tag():
    after = "<article><h1>Title</h1><p>It's the text of the article, with enough words to be one.</p></article>"
    want = "Title\nIt's the text of the article, with enough words to be one."
    for raw in (
        "<script>for(i=0;i<n;i++){a.push(i)}</script>", "<script>if(a<b)x='it\\'s'; // don't</SCRIPT >", "<script><!-- if (a<b) '</script>", "<style>a<b '{}</style\n>",
        "<title>a <b 'c</title>", "<script>'</scripts>'</script>", "<textarea><!-- <p a='</textarea>", "<script>i<n</script><script>i<n'</script>",
    ):
        assert html_text.main_text(raw + after) == want
    assert html_text.main_text(after + "<script>i<n") == want


def test_html_names_made_from_titles_are_no_boilerplate():
    long_ = "This paragraph is a part of the article and says in rather many words what its authors have found out about the matter, and why."
    for names in ('id="related-work"', 'id="legal-history"', 'class="search-algorithms"', 'id="search"', 'id="pagination"', 'id="cookies" class="level2"'):
        page = f"<article><h1>Title</h1><p>{long_}</p><section {names}><h2>Part of it</h2><p>{long_}</p><p>{long_}</p></section><p>End.</p></article>"
        got = html_text.main_text(page).split("\n")
        assert got.count(long_) == 3 and got[0] == "Title" and got[-1] == "End.", names
        # a whole name may cost the short heading, a part of one may not
        assert "Part of it" in got or names in ('id="search"', 'id="pagination"', 'id="cookies" class="level2"')
    page = f"<article><h2 id='legal'>Legal</h2><p>{long_}</p><div class='related-posts'><p>{long_}</p></div><div class='share'>Share this</div><p>End.</p></article>"
    assert html_text.main_text(page) == f"Legal\n{long_}\nEnd."


def test_html_formulas_are_text():
    formula = "<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation encoding='application/x-tex'>x = 1</annotation></semantics></math>"
    assert html_text.main_text(f"<article><p>If {formula}, then stop.</p></article>") == "If x=1, then stop."
    assert html_text.main_text("<article><p>If <math><mi>y</mi><annotation>y</math> then</p></article>") == "If y then"


def test_minimum_cut_against_all_labellings():
    draw = random.Random(4)
    for _ in range(300):
        n = draw.randint(1, 9)
        ends = [(draw.random() * 3, draw.random() * 3) for _ in range(n)]
        edges = {(i, j): draw.random() * 2 for i in range(n) for j in range(i + 1, n) if draw.random() < 0.4}
        cost = lambda side: sum(ends[i][0 if not side[i] else 1] for i in range(n)) + sum(c for (i, j), c in edges.items() if side[i] != side[j])
        assert cost(html_text.source_side(ends, edges)) == pytest.approx(min(map(cost, itertools.product([False, True], repeat=n))))


def test_html_edges(spark):
    pages = spark.createDataFrame([(1, None, None, "x"), (None, "u", "", "x"), (2, "u", "<p>a</p>" * 50_000, "x"), (2, "u", "<p>a</p>" * 50_000, "x")], "page_id int, url string, html string, text string")
    rows = html_text.extract(pages, keep=["page_id", "url"]).collect()
    assert [r.n_chars for r in rows] == [0, 0, 99_999, 99_999]
    assert html_text.extract(pages.limit(0), keep=["page_id"]).count() == 0


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_query_equals_the_library(spark, sf_dir, documents, reference):
    got = {r.doc_id: r for r in queries.op8_byte_bpe(spark, sf_dir).collect()}
    assert len(got) == len(documents)
    for doc_id, text in documents:
        ids = reference.encode_ordinary(text or "")
        r = got[doc_id]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_on_odd_strings(reference):
    tokens = byte_bpe.read_ranks(RANKS)
    whole = byte_bpe.PerfectHash(tokens)
    assert all(whole.get(t) == i for i, t in enumerate(tokens)) and sorted(whole.index_at) == list(range(len(tokens)))
    assert whole.get(b"no such pre-token") == -1
    encoder = byte_bpe.Encoder(tokens, whole, public_tokenizers.PATTERN)
    draw = random.Random(3)
    letters = " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0    　﻿ ab'sreLl12é中.!🙂  "
    for _ in range(5000):
        text = "".join(draw.choice(letters) for _ in range(draw.randint(0, 14)))
        ids = encoder.encode(text)
        assert list(ids) == reference.encode_ordinary(text), repr(text)
        assert encoder.decode(ids).decode() == text
    for text in ("aé" * 20_000, " " * 5000, "<|endoftext|>", "x" * 30_000):
        assert list(encoder.encode(text)) == reference.encode_ordinary(text)


def test_bpe_edges(odd, none):
    encoded = byte_bpe.encode(odd, RANKS, public_tokenizers.PATTERN, keep=["doc_id", "text"])
    rows = byte_bpe.decode(encoded, RANKS).collect()
    assert len(rows) == odd.count() and all(bytes(r.decoded).decode() == (r.text or "") for r in rows)
    assert byte_bpe.decode(byte_bpe.encode(none, RANKS, public_tokenizers.PATTERN), RANKS).count() == 0


def test_token_files_equal_the_library(spark, sf_dir, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(queries.BPE_JSON))
    got = {r.doc_id: r for r in queries.op9_token_files(spark, sf_dir).collect()}
    start = 0
    for doc_id, text in documents:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        r = got[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4")))
        start += len(ids)
    assert len(got) == len(documents)


def test_files_hold_equal_sequences_and_masks(spark, documents, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_ROWS", 30)
    frame = spark.createDataFrame(documents, "doc_id long, text string").repartition(5)
    folder = new_dir(spark, "files").removeprefix("file:")
    index = token_files.write(frame, public_tokenizers.path(queries.BPE_JSON), folder)
    rows = index.orderBy("start").collect()
    paths = sorted({r.path for r in rows})
    assert len(paths) > 3 and [r.doc_id for r in rows] == [d for d, _ in documents]
    stream = []
    for path in paths:
        file = token_files.SequenceFile(pa.memory_map(path))
        total = sum(r.n_tokens for r in rows if r.path == path)
        sequences = -(-total // token_files.SEQUENCE)
        ids, masks = zip(*(file.sequence(i) for i in range(sequences)))
        assert all(len(i) == token_files.SEQUENCE for i in ids)
        flat, mask = np.concatenate(ids), np.concatenate(masks)
        assert mask.sum() == total and mask[:total].all()
        # a sequence is a view of the mapped file, not a copy
        assert file.sequence(0)[0].flags["OWNDATA"] is False
        if total % token_files.SEQUENCE:
            with pytest.raises(ValueError):
                list(file.run(total - 1, 2))
        stream.append(flat[:total])
    assert sum(map(len, stream)) == sum(r.n_tokens for r in rows)


def test_added_tokens_are_those_of_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path(queries.BPE_JSON)
    library, own = Tokenizer.from_file(path), token_files.LibraryEncoder(path)
    added = {i: t.content for i, t in library.get_added_tokens_decoder().items()}
    token = next(iter(added.values()))
    texts = [f"one two{token}three  four", token, f" {token} five {token}{token}\nsix", "one two three", f"seven {token[:-1]} {token[1:]}", ""]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert set(added) & set(want[0]) and [ids.tolist() for ids in own.encode(texts, None)] == want
    assert [ids.tolist() for ids in own.encode(texts, 2)] == [[*ids, 2] for ids in want]


def test_forgotten_chunks_are_encoded_again(documents, monkeypatch):
    """An encoder that keeps a few chunks, and one that keeps none, give the library's ids."""
    path = public_tokenizers.path(queries.BPE_JSON)
    texts = [t or "" for _, t in documents[:60]] + ["a  b\tc", " x ", "\n", "one two", "two\none three"]
    library = Tokenizer.from_file(path)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for limit in (0, 50, 3_000):
        monkeypatch.setattr(token_files, "_MEMO", limit)
        own = token_files.LibraryEncoder(path)
        for _ in range(2):
            assert [ids.tolist() for i in range(0, len(texts), 7) for ids in own.encode(texts[i : i + 7], None)] == want


def test_chunks_are_looked_up_once_a_batch(documents):
    """Even and uneven texts and added tokens in one batch, encoded whole; known chunks are not encoded again, and no chunk costs a step of Python."""
    path = public_tokenizers.path(queries.BPE_JSON)
    library, own = Tokenizer.from_file(path), token_files.LibraryEncoder(path)
    token = next(iter(own.added))
    texts = [t or "" for _, t in documents[:700]] + ["", " ", "a  b", f"x{token}y z", "one two\u3000 three", "é\tü ß", "one"] * 2
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in own.encode(texts, None)] == want
    assert len(own.chunks) == len(set(own.chunks.to_pylist())) and len(own.start) == len(own.length) == len(own.uses) == len(own.chunks)
    before, encoded, plain = len(own.chunks), [], own._encode
    own._encode = lambda some: encoded.append(len(some)) or plain(some)
    assert [ids.tolist() for ids in own.encode(texts, 2)] == [[*ids, 2] for ids in want]
    assert len(own.chunks) == before and encoded == [len(texts)]
    # the same words a hundred times: their numbers are found without a call for each
    words, calls = ["one", "two", "three", "four"] * 25_000, []
    sys.setprofile(lambda frame, event, arg: calls.append(event))
    try:
        own.encode([" ".join(words)], None)
    finally:
        sys.setprofile(None)
    assert len(calls) < 5_000


def test_token_file_edges(spark, odd, none):
    index = token_files.write(odd, public_tokenizers.path(queries.BPE_JSON), new_dir(spark, "files"))
    rows = token_files.read(index).collect()
    assert len(rows) == odd.count() and min(r.n_tokens for r in rows) == 1
    ordered = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in ordered][:2] == [None, None] and [r.doc_id for r in ordered[2:]] == sorted(r.doc_id for r in rows if r.doc_id)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(ordered, ordered[1:]))
    empty = token_files.write(none, public_tokenizers.path(queries.BPE_JSON), new_dir(spark, "files"))
    assert token_files.read(empty).count() == 0


def test_lm_query_against_one_text_at_a_time(spark, sf_dir, documents, monkeypatch):
    """Counts and base exactly; the model's score by a plain loop over tokens with the trained weights."""
    kept = {}
    plain = gated_lm.train
    monkeypatch.setattr(gated_lm, "train", lambda *a: kept.setdefault("p", plain(*a)))
    monkeypatch.setattr(gated_lm, "KNOWN", 700)
    got = {r.doc_id: r for r in queries.op2_lm_scoring(spark, sf_dir).collect()}
    assert len(got) == len(documents)
    tokens = {i: [*words_of((t or "").encode(), lower=True), gated_lm.END] for i, t in documents}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    counts = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    known = dict(counts.most_common(gated_lm.HEAD + 100))
    vocabulary = gated_lm.Vocabulary(n, v, known, np.zeros(1), np.zeros(1))
    tails = Counter(), Counter()
    for w, c in counts.items():
        if w not in vocabulary.head:
            tails[0][gated_lm.tail_class(w)] += c
            tails[1][gated_lm.tail_class(w)] += 1
    better = 0
    for i, words in tokens.items():
        r = got[i]
        base = sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(words), sum(counts[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        better += (r.score - r.base_score) if held[i] else 0
        if len(words) < 300:
            assert r.score == pytest.approx(slow_score(kept["p"], vocabulary, tails, counts, words), rel=1e-4)
    assert better > 0


def slow_score(p, vocabulary, tails, counts, words):
    state, last, total, h = np.zeros(gated_lm.HIDDEN), gated_lm.HEAD + gated_lm.TAIL, 0.0, gated_lm.HIDDEN
    softmax = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    for word in words:
        x, a = p["x"][last].astype(float) + p["b"], state @ p["u"]
        z, r = 1 / (1 + np.exp(-(x[:h] + a[:h]))), 1 / (1 + np.exp(-(x[h : 2 * h] + a[h : 2 * h])))
        state = (1 - z) * np.tanh(x[2 * h :] + r * a[2 * h :]) + z * state
        classes = softmax(state @ p["c"] + p["cb"])
        at = vocabulary.head.get(word)
        if at is None:
            k = gated_lm.tail_class(word)
            last = gated_lm.HEAD + k
            total += np.log10(classes[gated_lm.CLASSES + k]) + np.log10((counts[word] + 1) / (tails[0][k] + tails[1][k] + 1))
        else:
            k, inner = divmod(at, gated_lm.HEAD // gated_lm.CLASSES)
            last = at
            total += np.log10(classes[k]) + np.log10(softmax(state @ p["w"][k] + p["wb"][k])[inner])
    return total


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    vocabulary = gated_lm.Vocabulary(900, 600, {b"w%d" % i: 600 - i for i in range(600)}, np.ones(gated_lm.TAIL), np.ones(gated_lm.TAIL))
    p = {k: v.astype(float) + (rng.normal(0, 0.1, v.shape) if k in "cw" else 0) for k, v in gated_lm.weights_of(vocabulary).items()}
    texts = [rng.integers(0, gated_lm.HEAD + gated_lm.TAIL, n) for n in (5, 12, 3, 9)]
    inputs, targets, owner = gated_lm.laid_out(texts, 2)
    used, state = owner >= 0, rng.normal(size=(inputs.shape[1], gated_lm.HIDDEN))

    def loss():
        states = gated_lm.forward(p, inputs, state).states
        return -gated_lm.log_probabilities(p, states[used], targets[used]).mean()

    g, _ = gated_lm.gradients(p, inputs, targets, used, state)
    for name in p:
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        p[name][at] += 1e-5
        high = loss()
        p[name][at] -= 2e-5
        assert g[name][at] == pytest.approx((high - loss()) / 2e-5, rel=1e-3)
        p[name][at] += 1e-5


def test_words_of_a_column_are_those_of_each_text():
    """Also empty words at the ends, bytes that are no UTF-8, white space of other alphabets, parts of a column."""
    texts = [b"", b" ", b"A b\x0bC\t", b"  \xff\xc3 X\xc2\xa0Y \x1c\x1f\x85 z", b"one", "ÉCOLE é\u3000中 🙂\n".encode(), b"\r\n\x0c", b"last  word"] * 3
    column = pa.array(texts, pa.binary())
    for part in (column, column.slice(3), column.slice(4, 7), column.slice(0, 1), column.slice(2, 0)):
        for lower in (False, True):
            words, lengths = split_words(part, lower)
            plain = [words_of(t, lower) for t in part.to_pylist()]
            assert words.to_pylist() == [w for ws in plain for w in ws] and lengths.tolist() == [len(ws) for ws in plain]


def test_reader_finds_ids_and_counts_of_each_word():
    known = {b"w%d" % i: 900 - i for i in range(800)} | {gated_lm.END: 50}
    texts = [b"W1 w2 w799 other\xff q ", b"", b"w700 w1 w1 Other q q"]
    for distinct, missing in ((801, 0.0), (5_000, np.nan)):
        vocabulary = gated_lm.Vocabulary(9_000, distinct, known, np.ones(gated_lm.TAIL), np.ones(gated_lm.TAIL))
        words, at, lengths, ids, logs = gated_lm.Reader(vocabulary).read(pa.array(texts, pa.binary()))
        plain = [[*words_of(t, lower=True), gated_lm.END] for t in texts]
        every = [w for ws in plain for w in ws]
        assert lengths.tolist() == [len(ws) for ws in plain]
        assert [[*words.to_pylist(), gated_lm.END][i] for i in at] == every and len(set(words.to_pylist())) == len(words)
        assert ids[at].tolist() == [vocabulary.head.get(w, gated_lm.HEAD + gated_lm.tail_class(w)) for w in every]
        assert np.array_equal(logs[at], [np.log10(known[w] + 1) if w in known else missing for w in every], equal_nan=True)


def test_reader_is_faster_than_a_lookup_of_every_word():
    rng = np.random.default_rng(3)
    data = [b" ".join(b"Word%d" % i for i in rng.zipf(1.3, 500) % 50_000) for _ in range(1_000)]
    known = {b"word%d" % i: 50_000 - i for i in range(20_000)} | {gated_lm.END: 1}
    reader = gated_lm.Reader(gated_lm.Vocabulary(10**6, 10**5, known, np.ones(gated_lm.TAIL), np.ones(gated_lm.TAIL)))

    def seconds(work):
        times = []
        for _ in range(5):
            began = time.process_time()
            work()
            times.append(time.process_time() - began)
        return min(times)

    column = pa.array(data, pa.binary())
    plain = seconds(lambda: [[known.get(w) for w in words_of(d, lower=True)] for d in data])
    assert seconds(lambda: reader.texts(column)) < 0.75 * plain


def test_windows_and_lanes_do_not_change_scores(monkeypatch):
    rng = np.random.default_rng(1)
    vocabulary = gated_lm.Vocabulary(900, 600, {b"w%d" % i: 600 - i for i in range(600)}, np.ones(gated_lm.TAIL), np.ones(gated_lm.TAIL))
    p = {k: v + (rng.normal(0, 0.3, v.shape).astype(np.float32) if k in "cwu" else 0) for k, v in gated_lm.weights_of(vocabulary).items()}
    texts = [rng.integers(0, gated_lm.HEAD + gated_lm.TAIL, n) for n in rng.integers(1, 90, 40)]
    whole = gated_lm.score_texts(p, texts)
    monkeypatch.setattr(gated_lm, "WINDOW", 7)
    monkeypatch.setattr(gated_lm, "SCORE_LANES", 3)
    assert np.allclose(whole, gated_lm.score_texts(p, texts), rtol=1e-4)
    assert np.allclose(whole, [gated_lm.score_texts(p, [t])[0] for t in texts], rtol=1e-4)


def test_lm_edges(spark, odd, none):
    from tidelog.llm.common import fold_of

    rows = gated_lm.scored(odd, fold_of("doc_id", 7) == 2).collect()
    assert len(rows) == odd.count()
    ones = [r for r in rows if r.doc_id == 1]
    assert len(ones) == 2 and ones[0] == ones[1]
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3, 5)} == {1}
    assert all(r.score < 0 and r.base_score < 0 for r in rows)
    assert gated_lm.scored(none, fold_of("doc_id", 7) == 2).count() == 0
    assert {r.train_tokens for r in gated_lm.scored(odd, fold_of("doc_id", 1) == 0).collect()} == {0}


def test_lm_trains_on_every_training_document(spark, documents, monkeypatch):
    """The rounds together read each text once, also where rows share an id or have none."""
    from pyspark.sql.classic.dataframe import DataFrame

    trained = []
    plain = DataFrame.toPandas

    def spied(frame):
        out = plain(frame)
        trained.append(0 if out.empty else int(out["n"].max()))
        return out

    rows = [(None if i % 3 else i, t) for i, t in documents]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    vocabulary = gated_lm.vocabulary_of(gated_lm.word_counts(frame, "text"))
    monkeypatch.setattr(DataFrame, "toPandas", spied)
    monkeypatch.setattr(gated_lm, "TASK_TOKENS", 10_000)
    gated_lm.train(frame, "text", "doc_id", vocabulary)
    assert len(trained) == gated_lm.ROUNDS and min(trained) > 0.3 * vocabulary.tokens
    assert sum(trained) == vocabulary.tokens == sum(len(words_of((t or "").encode())) + 1 for _, t in rows)


PLAIN = "array_join(transform(sequence(0, 90), i -> concat(char(97 + (i * i + id) % 26), 'ord', char(97 + (i * 7 + id) % 26), if(i % 9 = 8, '.', ''))), ' ')"


def test_invalid_bytes_in_every_query(spark, tmp_path):
    """A text that is no UTF-8 runs through every query and the pipeline, as if it held replacement characters."""
    from tidelog.llm import queries

    ids = spark.range(24).selectExpr("id as doc_id", f"concat(if(id % 6 = 0, cast(unhex('46FF6220') as string), ''), {PLAIN}) as text", "'en' as lang", "concat('s', id % 2) as source", "9L as n_chars")
    folder = str(tmp_path)
    ids.write.parquet(f"{folder}/documents.parquet")
    ids.selectExpr("doc_id", "int(doc_id % 2) as quality", "0 as toxic").write.parquet(f"{folder}/labels.parquet")
    ids.selectExpr("doc_id as item_id", "text").write.parquet(f"{folder}/benchmark.parquet")
    ids.selectExpr("doc_id as page_id", "concat('http://a.com/', doc_id) as url", "concat('<html><body><article><p>', text, '</p></article></body></html>') as html").write.parquet(f"{folder}/pages.parquet")
    ids.selectExpr("doc_id div 2 as conv_id", "doc_id % 2 as turn", "if(doc_id % 2 = 0, 'user', 'assistant') as role", "text").write.parquet(f"{folder}/conversations.parquet")
    for name, query in queries.QUERIES.items():
        rows = query(spark, folder).collect()
        assert rows or name == "pipeline", name
        if name in ("op8_byte_bpe", "op9_token_files", "op3_fingerprints", "op5_quality_rules"):
            assert len(rows) == 24
    pages = queries.op6_html_text(spark, folder).filter("page_id = 0").first()
    assert pages.text.startswith("F�b ")
