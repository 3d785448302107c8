"""Quality classifier on supervised subword embeddings.

A document is the average of learned vectors: one for each word and one for each
character n-gram of its words, hashed into a fixed number of buckets.  A word that
repeats the one before it is read as one special word, whatever it is.  A softmax
layer over the average gives the label.  Vectors and layer are trained together by
stochastic gradient descent in numpy on at most ``per_label`` labelled rows of each
label (the rows with the smallest id hashes); every text is then scored whole.  N-grams
are of characters, not bytes.  The gradient is that of the weighted cross-entropy; its
steps have a rate of their own for vectors, layer and bias, as averages of many vectors
give each of them a small gradient.

Scoring is linear up to the softmax, so a word needs only the sum of its vectors
times the layer and how many vectors it has; both are remembered per word.

Null and empty texts score as the prior that training leaves in the bias.  Equal
texts score alike.  With no label or one label only, the score is the smoothed
share of label 1.  Null ids take part as the empty id; labels of other values than
0 and 1 are not learned from.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import filtered_by_text, fold_of, held, per_text

BUCKETS = 1 << 16
DIMENSIONS = 8
NGRAMS = (3, 4)
PER_LABEL = 1_000
EPOCHS, BATCH, RATE = 12, 32, 0.5
#: Rates of vectors, layer and bias, as multiples of RATE.
VECTOR_RATE, LAYER_RATE, BIAS_RATE = 20, 1, 0.02
ACCEPT_FROM = 0.3
#: Words remembered, the longest of them in bytes, and n-gram positions handled at once.
_MEMO, _MEMO_WORD, _RUN = 400_000, 256, 1 << 16
_AGAIN = b"\x00"


def subwords(word: bytes) -> Iterator[list[int]]:
    """Buckets of a word, in runs of bounded size: the word itself and all character n-grams of the word between < and >."""
    marked = b"<" + word + b">"
    # where each character begins: every byte but those that continue one
    starts = range(len(marked)) if word.isascii() else [i for i, b in enumerate(marked) if b & 0xC0 != 0x80]
    ends = [*starts, len(marked)]
    for begin in range(0, len(starts), _RUN):
        out = [] if begin else [zlib.crc32(word) % BUCKETS]
        for n in NGRAMS:
            until = min(begin + _RUN, len(starts) - n + 1)
            out += [zlib.crc32(marked[ends[i] : ends[i + n]], n) % BUCKETS for i in range(begin, until)]
        yield out


def tokens(text: bytes) -> list[bytes]:
    words = text.split()
    if any(map(bytes.__eq__, words, words[1:])):
        words[1:] = [_AGAIN if a == b else b for a, b in zip(words, words[1:])]
    return words


def bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and the share of each; at most BUCKETS of them whatever its length."""
    total = np.zeros(BUCKETS, np.int64)
    counts: dict[bytes, int] = {}
    for word in tokens(text):
        counts[word] = counts.get(word, 0) + 1
    for word, n in counts.items():
        for at in subwords(word):
            np.add.at(total, at, n)
    at = np.flatnonzero(total)
    return at.astype(np.int32), (total[at] / max(total.sum(), 1)).astype(np.float32)


@dataclass
class Classifier:
    """Vectors, softmax layer (label by dimension) and its bias."""

    vectors: np.ndarray
    layer: np.ndarray
    bias: np.ndarray

    def word_logits(self) -> tuple[np.ndarray, float]:
        """Logit of label 1 against 0 for each bucket, and the bias."""
        return self.vectors @ (self.layer[1] - self.layer[0]), float(self.bias[1] - self.bias[0])


def gradients(model: Classifier, bags: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, weight: np.ndarray) -> tuple:
    """Of the weighted cross-entropy summed over some documents: by layer, bias, and the vectors of the buckets they touch."""
    ids = np.concatenate([b[0] for b in bags])
    shares = np.concatenate([b[1] for b in bags])
    rows = np.repeat(np.arange(len(bags)), [len(b[0]) for b in bags])
    parts = model.vectors[ids] * shares[:, None]
    average = np.stack([np.bincount(rows, parts[:, d], len(bags)) for d in range(DIMENSIONS)], axis=1)
    logits = average @ model.layer.T + model.bias
    p = np.exp(logits - logits.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    p[np.arange(len(bags)), target] -= 1
    p *= weight[:, None]
    each = (p @ model.layer)[rows] * shares[:, None]
    touched, inverse = np.unique(ids, return_inverse=True)
    by_bucket = np.stack([np.bincount(inverse, each[:, d], len(touched)) for d in range(DIMENSIONS)], axis=1)
    return p.T @ average, p.sum(0), touched, by_bucket


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[int], weights: list[float], seed: int = 7) -> Classifier:
    """Minibatch gradient descent on weighted cross-entropy; the rate falls linearly to zero."""
    rng = np.random.default_rng(seed)
    model = Classifier(
        rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)), np.zeros((2, DIMENSIONS)), np.zeros(2)
    )
    target, weight = np.asarray(labels, int), np.asarray(weights, float)
    if len(bags) == 0:
        return model
    share = float((weight * target).sum() / weight.sum())
    share = (share * len(bags) + 0.5) / (len(bags) + 1)
    model.bias = np.log([1 - share, share])
    if len(set(labels)) < 2:
        return model
    model.layer = rng.normal(0, 0.1, (2, DIMENSIONS))
    steps, step = EPOCHS * -(-len(bags) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for begin in range(0, len(bags), BATCH):
            chosen = order[begin : begin + BATCH]
            rate, step = RATE * (1 - step / steps), step + 1
            layer, bias, touched, vectors = gradients(model, [bags[i] for i in chosen], target[chosen], weight[chosen])
            model.layer -= rate * LAYER_RATE * layer
            model.bias -= rate * BIAS_RATE * bias
            model.vectors[touched] -= rate * VECTOR_RATE * vectors
    return model


def fit(documents: DataFrame, labels: DataFrame, label: str, training: str, per_label: int = PER_LABEL, id_: str = "doc_id", text: str = "text") -> Classifier:
    """Train on the labelled documents for which the SQL condition ``training`` over ``labels`` holds.

    The rows with the smallest hashes of the id are taken, up to ``per_label`` of
    each label; only their bags of buckets reach the driver.  The loss weighs
    rows so that both labels count as they do among all training labels.
    """
    known = labels.filter(training).filter(F.col(label).isin(0, 1) & F.col(id_).isNotNull()).groupBy(id_).agg(F.min(label).alias("_label"))
    totals = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken = None
    for value in sorted(totals):
        some = known.filter(F.col("_label") == value).orderBy(F.xxhash64(id_), id_).limit(per_label)
        taken = some if taken is None else taken.unionByName(some)
    if taken is None:
        return train([], [], [])
    # at most two times per_label small rows, so broadcast is safe; repeated ids count once
    sample = documents.select(id_, text).join(F.broadcast(taken), id_).groupBy(id_, "_label").agg(F.min(text).alias(text))

    def work(texts: list[bytes]) -> dict[str, list]:
        bags = [bag(t) for t in texts]
        return {"ids": [b[0].tolist() for b in bags], "shares": [b[1].tolist() for b in bags]}

    rows = per_text(sample, text, [id_, "_label"], "ids array<int>, shares array<float>", work).orderBy(F.xxhash64(id_), id_).collect()
    used = {v: sum(r["_label"] == v for r in rows) for v in totals}
    weights = [totals[r["_label"]] / used[r["_label"]] * len(rows) / sum(totals.values()) for r in rows]
    bags = [(np.array(r["ids"], np.int32), np.array(r["shares"], np.float32)) for r in rows]
    return train(bags, [r["_label"] for r in rows], weights)


class Scorer:
    """Scores texts; holds the sum and number of logits of each word met, up to a bound."""

    def __init__(self, logits: np.ndarray, bias: float):
        self.logits, self.bias = logits, bias
        self.place: dict[bytes, int] = {}
        self.sums: list[float] = []
        self.sizes: list[int] = []

    def _words(self, words: list[bytes]) -> tuple[list[float], list[int]]:
        place = self.place
        if len(self.sums) > _MEMO:
            place.clear(), self.sums.clear(), self.sizes.clear()
        new = set(words).difference(place)
        for word in new:
            runs = [(float(self.logits[at].sum()), len(at)) for at in subwords(word)]
            place[word] = len(self.sums)
            self.sums.append(sum(s for s, _ in runs))
            self.sizes.append(sum(n for _, n in runs))
        found = [place[w] for w in words]
        for word in new:
            if len(word) > _MEMO_WORD:
                del place[word]
        return [self.sums[i] for i in found], [self.sizes[i] for i in found]

    def score(self, text: bytes) -> float:
        sums, sizes = self._words(tokens(text))
        odds = self.bias + (sum(sums) / sum(sizes) if sizes else 0.0)
        return float(1 / (1 + np.exp(-np.clip(odds, -500, 500))))


def score(documents: DataFrame, model: Classifier, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``score`` (probability of label 1) of every text, after the ``keep`` columns."""
    logits, bias = model.word_logits()
    token = uuid.uuid4().hex

    def work(texts: list[bytes]) -> dict[str, list]:
        scorer = held(token, lambda: Scorer(logits, bias))
        return {"score": [scorer.score(t) for t in texts]}

    return per_text(documents, text, keep or [], "score double", work)


def accept(documents: DataFrame, model: Classifier, text: str = "text") -> DataFrame:
    """The rows scoring at least ACCEPT_FROM, all columns unchanged."""
    logits, bias = model.word_logits()
    token = uuid.uuid4().hex

    def keeps(texts: list[bytes]) -> list[bool]:
        scorer = held(token, lambda: Scorer(logits, bias))
        return [scorer.score(t) >= ACCEPT_FROM for t in texts]

    return filtered_by_text(documents, text, keeps)


def training_rows(folds: int = 5, id_: str = "doc_id"):
    """The condition of the fixed folds: labels are learned only from these rows."""
    return fold_of(id_, folds) != 0
