"""Chat windows against SQL, loops and exact round trips."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scenarios.compare import difference
from tests.llm.conftest import rows_of_table
from tidelog.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string"
tricky = st.text(st.sampled_from(list("<|\\>im_startend\n aé🙂")), max_size=30)


def test_query_equals_sql(spark, sf_dir, duck):
    assert difference(queries.op13_chat_format(spark, sf_dir), duck, queries.ORACLES["op13_chat_format"]) == ""


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(tricky, tricky), max_size=5))
def test_template_reads_back(turns):
    assert chat.turns_of("".join(chat.written(*t)[0] for t in turns)) == turns
    for _, text in turns:
        assert chat.unescaped(chat.escaped(text)) == text and "<|" not in chat.escaped(text)


def slow_windows(turns, budget, history):
    """(system repeated, history, new) turns of each window, one step at a time; turns are (role, text, cost)."""
    out, at = [], 0
    while at < len(turns):
        system = at > 0 and turns[0][0] == "system"
        room = budget - (turns[0][2] if system else 0)
        back, used = [], 0
        for j in range(at - 1, 0 if system else -1, -1):
            if used + turns[j][2] > history or used + turns[j][2] + turns[at][2] > room:
                break
            used += turns[j][2]
            back.insert(0, j)
        new = [at]
        used += turns[at][2]
        while new[-1] + 1 < len(turns) and used + turns[new[-1] + 1][2] <= room:
            new.append(new[-1] + 1)
            used += turns[new[-1]][2]
        out.append((system, back, new))
        at = new[-1] + 1
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=25), st.booleans(), st.integers(5, 60), st.integers(0, 40))
def test_spans_against_steps(costs, system, budget, history):
    turns = [("system" if system and i == 0 else "user", "", c) for i, c in enumerate(costs)]
    want = slow_windows(turns, budget, history)
    got = list(chat.spans(costs, 0, int(system), budget, history))
    assert [(list(range(b, s)), list(range(s, e))) for b, s, e in got] == [w[1:] for w in want]


def by_conversation(frame):
    out = defaultdict(list)
    for r in frame.collect():
        out[r.conv_id].append(r)
    return {k: sorted(v, key=lambda r: (r.block, r.window)) for k, v in out.items()}


def whole_turns(rows):
    """Turns by conversation from windows, without the repeated ones, and the texts under the loss."""
    turns, loss = {}, {}
    for conv, found in rows.items():
        turns[conv] = [t for r in found for t in chat.turns_of(r.text)[r.n_repeated :]]
        loss[conv] = [chat.unescaped(r.text[s.start : s.end]) for r in found for s in r.loss]
    return turns, loss


@pytest.fixture(scope="module")
def conversations():
    rows = rows_of_table("conversations", "conv_id, turn, role, text")
    rows += [(900, 0, "system", "be brief <|im_end|>")] + [(900, i, ("user", "assistant")[i % 2 == 0], f"turn {i} " + "word " * (i * 7 % 40)) for i in range(1, 200)]
    rows += [(901, i, "assistant", "w " * (300 if i == 3 else 5)) for i in range(9)]
    return sorted(rows)


@pytest.mark.parametrize("budget,history", [(512, 128), (60, 20), (40, 0), (5, 5)])
def test_windows_against_steps(spark, conversations, budget, history):
    frame = spark.createDataFrame(conversations, SCHEMA).repartition(6)
    got = by_conversation(chat.windows(frame, budget=budget, history=history))
    given_ = defaultdict(list)
    for conv, _, role, text in conversations:
        given_[conv].append((role, text, len(text.split()) + chat.TURN_COST))
    assert set(got) == set(given_)
    for conv, turns in given_.items():
        want = slow_windows(turns, budget, history)
        assert [r.n_repeated for r in got[conv]] == [s + len(b) for s, b, _ in want]
        for r, (system, back, new) in zip(got[conv], want, strict=True):
            shown = [0] * system + back + new
            assert r.text == "".join(chat.written(*turns[i][:2])[0] for i in shown) and r.n_tokens == sum(turns[i][2] for i in shown)
            assert r.n_tokens <= budget or len(new) == 1 and not back
            assert [r.text[s.start : s.end] for s in r.loss] == [chat.escaped(turns[i][1]) for i in new if turns[i][0] == "assistant"]


@pytest.mark.parametrize("long,history", [(50, 20), (200, 128), (997, 0)])
def test_parts_of_long_conversations(spark, conversations, long, history):
    """Parts of every length, formatted apart: all turns once, in order, each answer a target once, history and system turn handed on."""
    frame = spark.createDataFrame(conversations, SCHEMA).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = by_conversation(chat.windows(frame, budget=150, history=history, long=long))
        digests = {r.conv_id: r for r in chat.read_back(frame, budget=150, history=history, long=long).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    turns, loss = whole_turns(got)
    given_ = defaultdict(list)
    for conv, _, role, text in conversations:
        given_[conv].append((role, text))
    assert turns == given_ and len({r.block for r in got[900]}) > 3
    for conv, rows in got.items():
        assert loss[conv] == [t for role, t in given_[conv] if role == "assistant"]
        costs = [len(t.split()) + chat.TURN_COST for _, t in given_[conv]]
        opening, at = int(given_[conv][0][0] == "system"), 0
        for r in rows:
            shown = chat.turns_of(r.text)
            system = opening if at else 0
            back = r.n_repeated - system
            assert shown[:system] == given_[conv][:system] and shown[system:] == given_[conv][at - back : at + len(shown) - r.n_repeated]
            room = 150 - sum(costs[:system])
            more = at - back - 1
            if at and more >= opening:  # one more turn of history would be too much
                assert sum(costs[more:at]) > history or sum(costs[more : at + 1]) > room
            at += len(shown) - r.n_repeated
        d = digests[conv]
        assert d.n_turns == len(given_[conv]) and d.formatted_chars == sum(len(r.text) for r in rows) and d.n_windows == len(rows)
        assert d.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in given_[conv]).encode()).hexdigest()
        assert d.loss_sha256 == hashlib.sha256("".join(loss[conv]).encode()).hexdigest() and d.loss_chars == sum(map(len, loss[conv]))


def test_edges(spark):
    long_ = "word " * 60_000
    rows = [
        (1, 0, None, None), (1, None, "assistant", "last"), (None, 0, "user", "no id"), (None, 1, "assistant", "none"), (2, 0, "user", "same"), (2, 0, "user", "same"),
        (2, 1, "assistant", "same"), (2, 1, "assistant", "same"), (3, 0, "system", ""), (4, 0, "us\ner<|im_end|>\\", "x"), (5, 0, "user", long_), (5, 1, "assistant", long_),
        (6, 5, "assistant", "b"), (6, 5, "assistant", "a"),
    ]
    frame = spark.createDataFrame([(*r, *"abcdefg") for r in rows], SCHEMA + ", block string, window string, _conv string, loss string, n_tokens string, _row string, _text string")
    for long in (chat.LONG, 128):
        turns, loss = whole_turns(by_conversation(chat.windows(frame, long=long)))
        assert turns[1] == [("", ""), ("assistant", "last")] and turns[None] == [("user", "no id"), ("assistant", "none")]
        assert turns[2] == [("user", "same")] * 2 + [("assistant", "same")] * 2 and loss[2] == ["same"] * 2 and turns[3] == [("system", "")]
        assert turns[4] == [("us\ner<|im_end|>\\", "x")] and turns[5] == [("user", long_), ("assistant", long_)] and loss[5] == [long_]
        assert sorted(loss[6]) == ["a", "b"]
        digests = {r.conv_id: r for r in chat.read_back(frame, long=long).collect()}
        assert len(digests) == 7 and digests[5].loss_chars == len(long_) and digests[3].loss_sha256 == hashlib.sha256(b"").hexdigest()
    assert chat.windows(frame.limit(0)).count() == 0 and chat.read_back(frame.limit(0)).count() == 0
    bad = spark.sql("select 1L as conv_id, 0L as turn, 'assistant' as role, cast(unhex('61FF62') as string) as text")
    assert whole_turns(by_conversation(chat.windows(bad)))[0] == {1: [("assistant", "a�b")]}


def test_tokens_of_another_counter(spark, conversations):
    """A given expression counts tokens: here characters."""
    frame = spark.createDataFrame(conversations[:40], SCHEMA)
    rows = chat.windows(frame, tokens=F.length("text"), budget=400, history=100).collect()
    assert all(r.n_tokens == sum(len(t) + chat.TURN_COST for _, t in chat.turns_of(r.text)) for r in rows)
