"""Scoring texts with a gated recurrent language model.

A text is its words (A-Z lower-cased), then one end.  The HEAD most frequent words
and the end stand alone in CLASSES frequency classes; every other word belongs to
one of TAIL classes by its first two bytes.  A gated recurrent unit reads the text
and a class-factored softmax gives the next class; a head word is then drawn from a
softmax over its class, a tail word from the smoothed counts of its class.  So

    p(word | past) = p(class | state) * p(word | class, state or counts)

sums to one over the known words and one unknown word for each tail class.

Word counts are taken over all training documents.  The weights are trained by
truncated backpropagation in numpy on all of them: ROUNDS rounds divide the texts
between them, in each round tasks train copies on their parts and the copies are
averaged, so the work grows with the corpus and spreads over it.  Scoring reads every text whole:
lanes of texts run side by side through windows of WINDOW steps, the state goes from
one window to the next and is cleared only where a new text begins.

Null texts are empty: one end.  Equal texts score alike; repeated rows are each
returned.  Null ids are training documents by their crc32 of the empty text.  With
no training document N is 0 and every word unknown.  An empty table gives an empty
result.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heapify, heapreplace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import held, slices, split_words, stored, text_bytes

HEAD, CLASSES, TAIL, HIDDEN = 512, 16, 32, 16
#: Words whose counts every task holds; the counts of others are joined.
KNOWN = 200_000
ROUNDS, EPOCHS = 2, 1
TASK_TOKENS, LANES, WINDOW, RATE = 2_000_000, 128, 24, 0.01
#: In an average of trained copies the weights before it count as so many tokens, so few texts move them little.
START_TOKENS = 20_000
#: Lanes and texts scored at once: a long text costs its steps alone, so many others should run beside it.
SCORE_LANES, SCORE_ROWS = 512, 3_000
END = b"\n"
_IN_CLASS = HEAD // CLASSES
_OUT = CLASSES + TAIL
_START = HEAD + TAIL
#: Bytes of words that are counted at once.
_COUNTED = 48_000_000
#: Biases that hold the counts of all training words; what a task's texts say cannot better them.
_FIXED = frozenset(("cb", "wb"))


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[:2]) % TAIL


@dataclass
class Vocabulary:
    """What the counts of all training words give: sizes, known words with counts, sums of the tail classes."""

    tokens: int
    distinct: int
    known: dict[bytes, int]
    tail_tokens: np.ndarray
    tail_distinct: np.ndarray
    head: dict[bytes, int] = field(init=False)

    def __post_init__(self) -> None:
        ranked = sorted(self.known.items(), key=lambda x: (-x[1], x[0]))
        best = [w for w, _ in ranked if w != END][: HEAD - 1]
        ordered = sorted([*best, END], key=lambda w: (-self.known.get(w, 0), w))
        self.head = {w: i for i, w in enumerate(ordered)}


def weights_of(vocabulary: Vocabulary, seed: int = 5) -> dict[str, np.ndarray]:
    """Starting weights: the word counts as biases, which stay, so that an untrained model is the unigram model."""
    rng = np.random.default_rng(seed)
    counts = np.zeros(HEAD)
    for word, i in vocabulary.head.items():
        counts[i] = vocabulary.known.get(word, 0) + 1
    by_class = counts.reshape(CLASSES, _IN_CLASS)
    out = np.concatenate([by_class.sum(1), vocabulary.tail_tokens + 1]) + 1e-3
    with np.errstate(divide="ignore"):
        inner = np.log(by_class) - np.log(np.maximum(by_class.sum(1, keepdims=True), 1))
    small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    return {
        "x": small(_START + 1, 3 * HIDDEN), "u": small(HIDDEN, 3 * HIDDEN), "b": np.zeros(3 * HIDDEN, np.float32),
        "c": np.zeros((HIDDEN, _OUT), np.float32), "cb": np.log(out / out.sum()).astype(np.float32),
        "w": np.zeros((CLASSES, HIDDEN, _IN_CLASS), np.float32), "wb": np.where(by_class > 0, inner, -30).astype(np.float32),
    }


def _total(rows: np.ndarray) -> np.ndarray:
    """Sums of the columns, whose number of rows is a multiple of 8, in the order in which numpy sums a contiguous row."""
    r = rows.reshape(len(rows) // 8, 8, rows.shape[1]).sum(0)
    return ((r[0] + r[1]) + (r[2] + r[3])) + ((r[4] + r[5]) + (r[6] + r[7]))


def _log_sum(logits: np.ndarray) -> np.ndarray:
    high = logits.max(0, initial=-np.inf)
    return high + np.log(_total(np.exp(logits - high)))


def lanes_of(texts: list[np.ndarray], lanes: int) -> list[list[int]]:
    """Texts dealt to lanes of about equal length, longest text first; lanes longest first."""
    sizes = [len(t) for t in texts]
    # a lane shorter than the longest text would only wait for it
    n = max(1, min(lanes, len(texts), max(lanes // 8, sum(sizes) // max(sizes))))
    load = [(0, i) for i in range(n)]
    heapify(load)
    dealt: list[list[int]] = [[] for _ in range(n)]
    for t in sorted(range(len(texts)), key=lambda t: -len(texts[t])):
        size, lane = load[0]
        dealt[lane].append(t)
        heapreplace(load, (size + len(texts[t]), lane))
    return sorted(dealt, key=lambda lane: -sum(len(texts[t]) for t in lane))


def laid_out(texts: list[np.ndarray], lanes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Input, target and text number by step and lane; text number -1 after a lane's end."""
    dealt = lanes_of(texts, lanes)
    sizes = [sum(len(texts[t]) for t in lane) for lane in dealt]
    shape = (max(sizes), len(dealt))
    inputs, targets, owner = np.full(shape, _START, np.int32), np.zeros(shape, np.int32), np.full(shape, -1, np.int32)
    for column, (lane, size) in enumerate(zip(dealt, sizes)):
        if not size:
            continue
        whole = np.concatenate([texts[t] for t in lane])
        targets[:size, column] = whole
        inputs[1:size, column] = whole[:-1]
        lengths = [len(texts[t]) for t in lane]
        owner[:size, column] = np.repeat(lane, lengths)
        inputs[np.cumsum([0, *lengths[:-1]]), column] = _START
    return inputs, targets, owner


@dataclass
class Window:
    """What each step and lane of a window gave: the state before and after it, both gates, the new part and its recurrent sum."""

    before: np.ndarray
    states: np.ndarray
    gates: np.ndarray
    new: np.ndarray
    inner: np.ndarray
    #: Whether any lane's state was cleared at the step.
    cleared: list[bool]


def forward(p: dict[str, np.ndarray], inputs: np.ndarray, state: np.ndarray) -> Window:
    """The unit run over a window.  A start input clears the state."""
    shape, h2 = inputs.shape, 2 * HIDDEN
    # the gates are logistic functions by way of tanh, which takes half of their sums
    table, u = p["x"] + p["b"], p["u"].copy()
    table[:, :h2] *= 0.5
    u[:, :h2] *= 0.5
    x = table.take(inputs, axis=0)
    befores, states, gates_, news, sums = (np.empty((*shape, n), x.dtype) for n in (HIDDEN, HIDDEN, h2, HIDDEN, h2 + HIDDEN))
    starts = inputs == _START
    cleared = starts.any(1).tolist()
    for t in range(len(inputs)):
        before, gates, new, a = befores[t], gates_[t], news[t], sums[t]
        before[...] = state
        if cleared[t]:
            before[starts[t]] = 0
        np.matmul(before, u, out=a)
        state = states[t]
        np.add(x[t, :, :h2], a[:, :h2], out=gates)
        np.tanh(gates, out=gates)
        gates += 1
        gates *= 0.5
        np.multiply(gates[:, HIDDEN:], a[:, h2:], out=new)
        new += x[t, :, h2:]
        np.tanh(new, out=new)
        np.subtract(before, new, out=state)
        state *= gates[:, :HIDDEN]
        state += new
    return Window(befores, states, gates_, news, sums[..., h2:], cleared)


def class_of(targets: np.ndarray) -> np.ndarray:
    return np.where(targets < HEAD, targets // _IN_CLASS, targets - HEAD + CLASSES)


def _by_class(targets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of each target; the head targets in the order of their classes, and where each class begins and ends among them."""
    classes = class_of(targets)
    # narrow numbers are sorted in linear time
    order = np.argsort(classes.astype(np.uint8), kind="stable")
    ends = np.searchsorted(classes[order], np.arange(CLASSES + 1))
    return classes, order[: ends[-1]], ends


def _outer_logits(p: dict[str, np.ndarray], states: np.ndarray) -> np.ndarray:
    """Logits of the classes, a column for each state: sums and maxima then run along rows."""
    logits = p["c"].T @ states.T
    logits += p["cb"][:, None]
    return logits


def _inner_logits(p: dict[str, np.ndarray], states: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Logits within its class of each head target, a column for each, given their states in the order of classes."""
    out = np.empty((_IN_CLASS, len(states)), states.dtype)
    for k in range(CLASSES):
        if ends[k] < ends[k + 1]:
            rows = slice(ends[k], ends[k + 1])
            np.add(p["w"][k].T @ states[rows].T, p["wb"][k][:, None], out=out[:, rows])
    return out


def log_probabilities(p: dict[str, np.ndarray], states: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural logarithms of p(class | state), times p(word | class, state) for head words."""
    classes, order, ends = _by_class(targets)
    logits = _outer_logits(p, states)
    out = logits[classes, np.arange(len(targets))] - _log_sum(logits)
    inner = _inner_logits(p, states[order], ends)
    out[order] += inner[targets[order] % _IN_CLASS, np.arange(len(order))] - _log_sum(inner)
    return out


def score_texts(p: dict[str, np.ndarray], texts: list[np.ndarray]) -> np.ndarray:
    """Sum of ``log_probabilities`` of each whole text."""
    total = np.zeros(len(texts))
    if not texts:
        return total
    inputs, targets, owner = laid_out(texts, SCORE_LANES)
    state = np.zeros((inputs.shape[1], HIDDEN), np.float32)
    for begin in range(0, len(inputs), WINDOW):
        # lanes are sorted by length, so those at their end are the last columns
        live = int((owner[begin] >= 0).sum())
        window = slice(begin, begin + WINDOW)
        states = forward(p, inputs[window, :live], state[:live]).states
        state = states[-1]
        used = owner[window, :live] >= 0
        logs = log_probabilities(p, states[used], targets[window, :live][used])
        total += np.bincount(owner[window, :live][used], logs, len(texts))
    return total


def _softmax_error(logits: np.ndarray, goals: np.ndarray, scale: np.float32) -> np.ndarray:
    """Derivative of the scaled loss by the logits, in their place."""
    logits -= logits.max(0, initial=-np.inf)
    np.exp(logits, out=logits)
    logits /= _total(logits)
    logits[goals, np.arange(len(goals))] -= 1
    logits *= scale
    return logits


def gradients(p: dict[str, np.ndarray], inputs: np.ndarray, targets: np.ndarray, used: np.ndarray, state: np.ndarray) -> tuple[dict, np.ndarray]:
    """Gradients of the mean loss over one window, and the state after it; what came before the window is a constant."""
    w = forward(p, inputs, state)
    flat, goals = w.states[used], targets[used]
    scale = flat.dtype.type(1 / max(len(flat), 1))
    g = {k: np.zeros_like(v) for k, v in p.items()}
    classes, order, ends = _by_class(goals)
    # a row for each state again: products of few rows depend on the layout in their last digits
    d = np.ascontiguousarray(_softmax_error(_outer_logits(p, flat), classes, scale).T)
    g["c"], g["cb"] = flat.T @ d, d.sum(0)
    back = d @ p["c"].T
    head = flat[order]
    d = np.ascontiguousarray(_softmax_error(_inner_logits(p, head, ends), goals[order] % _IN_CLASS, scale).T)
    inner_back = np.empty_like(head)
    for k in range(CLASSES):
        if ends[k] < ends[k + 1]:
            rows = slice(ends[k], ends[k + 1])
            g["w"][k], g["wb"][k] = head[rows].T @ d[rows], d[rows].sum(0)
            np.matmul(d[rows], p["w"][k].T, out=inner_back[rows])
    back[order] += inner_back
    outer = np.zeros_like(w.states)
    outer[used] = back

    # what a step's error is multiplied by, for all steps at once; the loop goes back through the states
    z, r = w.gates[..., :HIDDEN], w.gates[..., HIDDEN:]
    to_new = (1 - z) * (1 - w.new * w.new)
    to_gates = np.concatenate([(w.before - w.new) * z * (1 - z), to_new * w.inner * r * (1 - r)], axis=2)
    da, dnew = np.empty((*inputs.shape, 3 * HIDDEN), flat.dtype), np.empty_like(w.new)
    back_u, later = np.ascontiguousarray(p["u"].T), np.zeros_like(state)
    for t in range(len(inputs) - 1, -1, -1):
        later += outer[t]
        gates, new = da[t], dnew[t]
        np.multiply(later, to_gates[t, :, :HIDDEN], out=gates[:, :HIDDEN])
        np.multiply(later, to_gates[t, :, HIDDEN:], out=gates[:, HIDDEN : 2 * HIDDEN])
        np.multiply(later, to_new[t], out=new)
        np.multiply(new, r[t], out=gates[:, 2 * HIDDEN :])
        later *= z[t]
        later += gates @ back_u
        if w.cleared[t]:
            later[inputs[t] == _START] = 0
    g["u"] = w.before.reshape(-1, HIDDEN).T @ da.reshape(-1, 3 * HIDDEN)
    da[..., 2 * HIDDEN :] = dnew
    flat_x = da.reshape(-1, 3 * HIDDEN)
    g["b"] = flat_x.sum(0)
    at = inputs.ravel().astype(np.int16)
    order = np.argsort(at, kind="stable")
    ids, first = np.unique(at[order], return_index=True)
    g["x"][ids] = np.add.reduceat(flat_x[order], first)
    return g, w.states[-1]


class Trainer:
    """Adam steps on windows of texts."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = {k: v.copy() for k, v in p.items()}
        self.mean = {k: np.zeros_like(v) for k, v in p.items()}
        self.square = {k: np.zeros_like(v) for k, v in p.items()}
        self.count = self.tokens = 0

    def learn(self, texts: list[np.ndarray]) -> None:
        inputs, targets, owner = laid_out(texts, LANES)
        state = np.zeros((inputs.shape[1], HIDDEN), np.float32)
        for begin in range(0, len(inputs), WINDOW):
            live = int((owner[begin] >= 0).sum())
            window = (slice(begin, begin + WINDOW), slice(0, live))
            used = owner[window] >= 0
            g, state = gradients(self.p, inputs[window], targets[window], used, state[:live])
            self.tokens += int(used.sum())
            self.step(g)

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.count += 1
        norm = float(np.sqrt(sum(float((v * v).sum()) for v in g.values())))
        clip = np.float32(min(1.0, 1.0 / max(norm, 1e-9)))
        warm = min(1.0, self.count / 20)
        fix = np.sqrt(1 - 0.99**self.count) / (1 - 0.9**self.count)
        for k, v in g.items():
            if k in _FIXED:
                continue
            v = v * clip
            self.mean[k] += np.float32(0.1) * (v - self.mean[k])
            self.square[k] += np.float32(0.01) * (v * v - self.square[k])
            self.p[k] -= np.float32(RATE * warm * fix) * self.mean[k] / (np.sqrt(self.square[k]) + np.float32(1e-7))


def word_counts(documents: DataFrame, text: str) -> DataFrame:
    """``word binary, c`` over all rows, ends included; tasks count what they read before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Array] = []
        size = rows = 0

        def flushed() -> pa.RecordBatch:
            found = pa.chunked_array(waiting, pa.binary()).value_counts()
            waiting.clear()
            return pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], names=["word", "c"])

        for batch in batches:
            for part in slices(batch):
                words, _ = split_words(part.column(0), lower=True)
                waiting.append(words)
                size, rows = size + words.nbytes, rows + part.num_rows
                if size > _COUNTED:
                    yield flushed()
                    size = 0
        yield flushed()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([rows], pa.int64())], names=["word", "c"])

    parts = documents.select(text_bytes(text).alias("_text")).mapInArrow(run, "word binary, c bigint")
    return parts.groupBy("word").agg(F.sum("c").alias("c"))


def vocabulary_of(counts: DataFrame) -> Vocabulary:
    """Sizes, tail sums and the words of the highest counts, at most KNOWN of them, found without a sort."""
    level = F.floor(F.log2("c") * 16)
    levels = sorted(counts.groupBy(level.alias("l")).agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("c")).collect(), reverse=True)
    tokens, distinct = sum(r.c for r in levels), sum(r.n for r in levels)
    lowest, taken = 1 << 40, 0
    for row in levels:
        if taken + row.n > KNOWN:
            break
        lowest, taken = row.l, taken + row.n
    known = {bytes(r.word): r.c for r in counts.filter((level >= lowest) | (F.col("word") == F.lit(END))).collect()}
    vocabulary = Vocabulary(tokens, distinct, known, np.zeros(TAIL), np.zeros(TAIL))
    group = F.crc32(F.substring("word", 1, 2)) % TAIL
    for row in counts.groupBy(group.alias("g")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n")).collect():
        vocabulary.tail_tokens[row.g], vocabulary.tail_distinct[row.g] = row.c, row.n
    for word in vocabulary.head:
        if known.get(word):
            vocabulary.tail_tokens[tail_class(word)] -= known[word]
            vocabulary.tail_distinct[tail_class(word)] -= 1
    return vocabulary


class Reader:
    """Turns texts into model ids and logarithms of counts, a batch at a time; each distinct word of a batch is looked up once."""

    def __init__(self, vocabulary: Vocabulary):
        head, known = vocabulary.head, vocabulary.known
        self.known = pa.array(known, pa.binary())
        self.known_ids = np.array([head[w] if w in head else HEAD + tail_class(w) for w in known], np.int32)
        self.known_logs = self._logs(known.values())
        self.end = head[END], self._logs([known.get(END, 0)])[0]
        # the counts of other words, if there are any, must be joined
        self.missing = -0.0 if len(known) == vocabulary.distinct else np.nan
        self.tails = np.array([tail_class(b"%c" % i) for i in range(256)] + [tail_class(i.to_bytes(2)) for i in range(1 << 16)], np.int32)

    @staticmethod
    def _logs(counts) -> np.ndarray:
        """log10(count + 1)."""
        counts = np.fromiter(counts, float)
        return np.where(counts > 0, np.log10(counts + 1), -0.0)

    def _tail_ids(self, words: pa.Array) -> np.ndarray:
        """Model ids that words have unless they are in the head: those of their first two bytes."""
        at = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2], np.uint8)
        first, two = at[:-1], np.diff(at) > 1
        second = np.where(two, first + 1, first)
        return HEAD + self.tails[np.where(two, 256 + 256 * data[first].astype(np.int32) + data[second], data[first])]

    def read(self, data: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The distinct words of the texts; positions of all words, one text after the other, among them (an end's
        comes after all of them) and the number of words of each text; model ids and log10(count + 1) by position,
        the latter NaN for words whose count must be joined.
        """
        words, lengths = split_words(data, lower=True)
        coded = words.dictionary_encode()
        distinct, n = coded.dictionary, len(coded.dictionary)
        lengths = lengths + 1
        at = np.full(int(lengths.sum()), n, np.int32)
        inside = np.ones(len(at), bool)
        inside[np.cumsum(lengths) - 1] = False
        at[inside] = coded.indices.to_numpy()
        ids, logs = np.full(n + 1, self.end[0], np.int32), np.full(n + 1, self.end[1])
        if n:
            place = pc.index_in(distinct, value_set=self.known).fill_null(-1).to_numpy()
            found = place >= 0
            ids[:n] = self._tail_ids(distinct)
            ids[:n][found] = self.known_ids[place[found]]
            logs[:n] = self.missing
            logs[:n][found] = self.known_logs[place[found]]
        return distinct, at, lengths, ids, logs

    def texts(self, data: pa.Array) -> list[np.ndarray]:
        """The model ids of each text."""
        _, at, lengths, ids, _ = self.read(data)
        return np.split(ids[at], np.cumsum(lengths)[:-1]) if len(data) else []


def train(documents: DataFrame, text: str, id_: str, vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """Weights after ROUNDS of training on tasks of about TASK_TOKENS tokens each and averaging; every text is in one round."""
    p = weights_of(vocabulary)
    names, shapes = list(p), {k: v.shape for k, v in p.items()}
    tasks = max(1, round(vocabulary.tokens / ROUNDS / TASK_TOKENS))
    # the text as well: rows that share an id, or have none, are not one task's
    row = F.xxhash64(F.lit("lm"), F.col(id_), text_bytes(text))
    for turn in range(ROUNDS):
        part = documents.filter(F.pmod(row, F.lit(ROUNDS)) == turn).select(text_bytes(text).alias("_text"), row.alias("_row"))
        start = p

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            reader, trainer = Reader(vocabulary), Trainer(start)
            for batch in batches:
                texts = [t for some in slices(batch) for t in reader.texts(some.column(0))]
                for _ in range(EPOCHS if texts else 0):
                    trainer.learn(texts)
            if trainer.tokens:
                flat = np.concatenate([trainer.p[k].ravel() for k in names]).astype(np.float64)
                columns = np.arange(len(flat)), flat * trainer.tokens, np.full(len(flat), float(trainer.tokens))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["i", "v", "n"])

        trained = part.repartition(tasks, "_row").sortWithinPartitions("_row", "_text").mapInArrow(run, "i bigint, v double, n double")
        total = trained.groupBy("i").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).toPandas().sort_values("i")
        if len(total):
            before = np.concatenate([p[k].ravel() for k in names])
            flat = ((total["v"] + START_TOKENS * before) / (total["n"] + START_TOKENS)).to_numpy(np.float32)
            cuts = np.cumsum([int(np.prod(shapes[k])) for k in names])[:-1]
            p = {k: v.reshape(shapes[k]) for k, v in zip(names, np.split(flat, cuts))}
    return p


def scored(documents: DataFrame, held_out: Column, text: str = "text", id_: str = "doc_id") -> DataFrame:
    """``id_, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Learns from the rows where ``held_out`` is false.  Words beyond the known ones
    leave the scoring tasks as rows and meet their counts in a join; a text's own
    row travels with them under a word that no text can hold.
    """
    rows = documents.withColumn("_held", F.coalesce(held_out, F.lit(False)))
    training = rows.filter(~F.col("_held"))
    counts = stored(word_counts(training, text), "lm-counts")
    vocabulary = vocabulary_of(counts)
    weights = train(training, text, id_, vocabulary)
    size = np.log10(vocabulary.tokens + vocabulary.distinct + 1)
    tail_size = np.log10(vocabulary.tail_tokens + vocabulary.tail_distinct + 1)
    id_type = documents.schema[id_].dataType.simpleString()
    token = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = held(token, lambda: Reader(vocabulary))
        for batch in batches:
            for part in slices(batch, rows=SCORE_ROWS):
                distinct, at, lengths, by_id, by_log = reader.read(part.column(0))
                ids, logs, ends = by_id[at], by_log[at], np.cumsum(lengths)
                texts = np.split(ids, ends[:-1])
                open_, tail = np.isnan(logs), ids >= HEAD
                summed = lambda values: np.add.reduceat(values, ends - lengths)
                known = summed((logs > 0).astype(np.int64))
                logs[open_] = 0
                outer = np.where(tail, logs - tail_size[np.where(tail, ids - HEAD, 0)], 0)
                base, outside = summed(logs - size), summed(outer)
                model = score_texts(weights, texts) / np.log(10)
                # each text's own row, then a row for each of its words whose count must be joined
                n, size_ = len(lengths), max(len(distinct), 1)
                pairs, times = np.unique(np.repeat(np.arange(n), lengths)[open_] * size_ + at[open_], return_counts=True)
                words_ = pa.concat_arrays([pa.array([END] * n, pa.binary()), distinct.take(pa.array(pairs % size_))])
                taken = part.select(["_id", "_held", "_hash"]).take(pa.array(np.concatenate([np.arange(n), pairs // size_])))
                none = np.zeros(len(pairs), np.int64)
                spread = lambda values, kind: pa.array(np.concatenate([values, none]).astype(kind))
                yield pa.RecordBatch.from_arrays(
                    [
                        *taken.columns, words_, pa.array(np.concatenate([np.zeros(n, np.int64), times])),
                        spread(lengths, np.int64), spread(known, np.int64), spread(base, float), spread(outside + model, float),
                    ],
                    names=["_id", "_held", "_hash", "word", "_times", "_tokens", "_known", "_base", "_score"],
                )

    source = rows.select(text_bytes(text).alias("_text"), F.col(id_).alias("_id"), "_held", F.xxhash64(text_bytes(text)).alias("_hash"))
    found = source.mapInArrow(
        run, f"_id {id_type}, _held boolean, _hash bigint, word binary, _times bigint, _tokens bigint, _known bigint, _base double, _score double"
    )
    # own rows get a word of their own (the end's bytes, then their hash), which spreads them over the join
    own = F.concat(F.lit(b"\n"), F.col("_hash").cast("string").cast("binary"))
    found = found.withColumn("word", F.when(F.col("_times") == 0, own).otherwise(F.col("word")))
    open_log = F.expr("_times * coalesce(log10(double(c) + 1), 0D)")
    joined = found.join(counts, "word", "left").groupBy("_id", "_held", "_hash").agg(
        F.sum((F.col("_times") == 0).cast("int")).alias("_copies"), F.sum("_tokens").alias("_tokens"),
        F.sum(F.col("_known") + F.when(F.col("c") > 0, F.col("_times")).otherwise(0)).alias("_known"),
        F.sum(F.col("_base") + open_log).alias("_base"), F.sum(F.col("_score") + open_log).alias("_score"),
    )
    # identical rows were added up; they are returned as often as they came
    return joined.withColumn("_copy", F.explode(F.expr("sequence(1, int(_copies))"))).select(
        F.col("_id").alias(id_), F.col("_held").alias("held_out"), F.expr("_tokens div _copies").alias("n_tokens"),
        F.expr("_known div _copies").alias("n_known"), F.lit(vocabulary.tokens).cast("bigint").alias("train_tokens"),
        (F.col("_base") / F.col("_copies")).alias("base_score"), (F.col("_score") / F.col("_copies")).alias("score"),
    )
