"""Quality rules as weak supervision.

Each rule looks at counts of one text and votes good (1), bad (-1) or abstains (0).
No rule is trusted by itself: expectation-maximisation over the votes of all
documents estimates how often each rule gives each vote for good and for bad
documents, and the posterior probability of "good" replaces all-must-pass
filtering.  The documents enter the estimate only as counts per vote pattern, at
most 3 ** len(RULES) of them, so what reaches the driver is bounded.

Null text: no words.  Empty texts and texts under MIN_WORDS words fail the base
check, like texts whose words are mostly repeated windows.  Repeated rows are
judged alike; null ids are kept.  An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import filtered_by_text, per_text, stored

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
KEEP_FROM = 0.5
#: The share of good documents before any vote is a parameter, as votes alone cannot tell it.
CLASS_BALANCE = 0.9
START, START_ACCURACY = 10, 0.9
#: The most that one vote can say, in log-odds.
MOST = 8.0

_UPPER = bytes(range(65, 91))
_ENDS = tuple(mark + space for mark in (b".", b"?", b"!") for space in (b" ", b"\n"))
#: A word of these alone holds no letter and no digit: bullets, pipes, rules.
_SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_NOT_LETTERS = bytes(b for b in range(128) if not (65 <= b <= 90 or 97 <= b <= 122))

STATS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "n_lines bigint, n_letters bigint, n_upper bigint, n_bangs bigint, n_bare bigint, n_runs bigint, n_distinct bigint, n_stops bigint, n_marked bigint"
)
STAT_NAMES = [s.split()[0] for s in STATS.split(", ")]

#: name, measured share (numerator, denominator), bad above, good up to (None: the rule never says good).
#: Between the two the rule abstains.  A symptom that is absent says nothing: most rules vote bad or abstain.
RULES = (
    ("symbols", "n_symbols", "n_words", 0.10, None),
    ("symbol_characters", "n_symbols", "word_chars", 0.05, None),
    ("marked_words", "n_marked", "n_words", 0.15, 0.02),
    ("repeated_windows", "n_repeat_words", "n_words", 0.30, None),
    ("repeated_lines", "n_dup_lines", "n_lines", 0.50, None),
    ("capitals", "n_upper", "n_letters", 0.40, None),
    ("exclamation", "n_bangs", "n_words", 0.10, None),
    ("bare_symbols", "n_bare", "n_words", 0.10, None),
    ("stutter", "n_runs", "n_words", 0.10, None),
    ("few_distinct", "n_rest", "n_words", 0.85, 0.60),
    ("sentences", "n_open", "n_words", 1.00, 0.98),
)


def repeated_words(words: list[bytes]) -> int:
    """How many words stand in a three-word window that the text holds twice or more.

    Window hashes only find candidates; windows that may repeat are compared as words.
    """
    n = len(words) - 2
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    with np.errstate(over="ignore"):
        windows = (hashes[:-2] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[2:]
    _, back, counts = np.unique(windows, return_inverse=True, return_counts=True)
    candidates = np.flatnonzero(counts[back] > 1).tolist()
    if not candidates:
        return 0
    seen: dict[tuple, int] = {}
    keys = [(words[i], words[i + 1], words[i + 2]) for i in candidates]
    for key in keys:
        seen[key] = seen.get(key, 0) + 1
    covered = np.zeros(len(words), bool)
    starts = np.array([i for i, key in zip(candidates, keys) if seen[key] > 1], int)
    for step in range(3):
        covered[starts + step] = True
    return int(covered.sum())


def stats_of(text: bytes) -> tuple:
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    letters = text.translate(None, _NOT_LETTERS)
    distinct, n_symbols = set(words), len(text) - len(text.translate(None, SYMBOLS))
    return (
        len(words), len(b"".join(words).decode()), n_symbols,
        len(lines) - len(set(lines)), repeated_words(words), len(lines), len(letters),
        len(letters) - len(letters.translate(None, _UPPER)), text.count(b"!!"),
        sum(words.count(w) for w in distinct if len(w) <= 3 and not w.translate(None, _SIGNS)),
        sum(map(bytes.__eq__, words, words[1:])), len(distinct),
        sum(text.count(end) for end in _ENDS) + text.endswith((b".", b"?", b"!")),
        sum(len(w) > len(w.translate(None, SYMBOLS)) for w in words) if n_symbols else 0,
    )


def stats(texts: list[bytes]) -> dict[str, list]:
    rows = [stats_of(t) for t in texts]
    return dict(zip(STAT_NAMES, map(list, zip(*rows)))) if rows else {n: [] for n in STAT_NAMES}


def votes(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Votes of all rules, one row for each document; a rule without a denominator abstains."""
    counts = {k: np.asarray(v, dtype=np.int64) for k, v in counts.items()}
    counts["n_rest"] = counts["n_words"] - counts["n_distinct"]
    counts["n_open"] = counts["n_words"] - counts["n_stops"]
    out = np.zeros((len(counts["n_words"]), len(RULES)), np.int8)
    for r, (_, part, whole, bad, good) in enumerate(RULES):
        share = counts[part] / np.maximum(counts[whole], 1)
        says_good = 0 if good is None else (share <= good).astype(np.int8)
        out[:, r] = np.where(counts[whole] == 0, 0, np.where(share > bad, -1, says_good))
    return out


def patterns(cast: np.ndarray) -> np.ndarray:
    """A vote row as one number in base three."""
    return (cast.astype(np.int64) + 1) @ (3 ** np.arange(cast.shape[1], dtype=np.int64))


def base_failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    n_words, repeated = np.asarray(counts["n_words"], np.int64), np.asarray(counts["n_repeat_words"], np.int64)
    return (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n_words)


@dataclass(frozen=True)
class LabelModel:
    """Log-odds of "good" without votes, and what each rule's vote (bad, abstain, good) adds to them.

    ``accuracies`` holds, for each rule, how often its bad and its good votes are right.
    """

    prior: float
    weights: tuple[tuple[float, float, float], ...]
    accuracies: tuple[tuple[float, float], ...]

    def posterior(self, pattern: np.ndarray) -> np.ndarray:
        odds = np.full(len(pattern), self.prior)
        for r, weight in enumerate(self.weights):
            odds += np.asarray(weight)[(pattern // 3**r) % 3]
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit_counts(pattern: list[int], count: list[int], rounds: int = 300) -> LabelModel:
    """Expectation-maximisation over vote patterns and how many documents have each.

    An abstention says nothing.  A vote moves the log-odds by how much more often
    good documents get it than bad ones, but never against its own sense, so "good"
    stays the class that good votes stand for.  The estimate starts from "bad if
    any rule says so"; START documents for each vote, right in START_ACCURACY of
    them, define rules that never vote and vanish against large counts.
    """
    n_rules = len(RULES)
    codes, weight = np.asarray(pattern, np.int64), np.asarray(count, float)
    cast = np.stack([(codes // 3**r) % 3 for r in range(n_rules)], axis=1) if len(codes) else np.zeros((0, n_rules), int)
    good = np.where((cast == 0).any(1), 1 - START_ACCURACY, CLASS_BALANCE)
    prior = np.log(CLASS_BALANCE) - np.log(1 - CLASS_BALANCE)
    for _ in range(rounds):
        table, accuracy = np.zeros((n_rules, 3)), np.empty((n_rules, 2))
        of_good, of_bad = weight @ good + START * CLASS_BALANCE, weight @ (1 - good) + START * (1 - CLASS_BALANCE)
        for r in range(n_rules):
            for side, right in ((0, 1 - START_ACCURACY), (1, START_ACCURACY)):
                cases = weight * (cast[:, r] == 2 * side)
                hits, misses = cases @ good + START * right, cases @ (1 - good) + START * (1 - right)
                odds = np.log(hits / of_good) - np.log(misses / of_bad)
                table[r, 2 * side] = np.clip(odds, 0, MOST) if side else np.clip(odds, -MOST, 0)
                accuracy[r, side] = (hits if side else misses) / (hits + misses)
        new = 1 / (1 + np.exp(-(prior + table[np.arange(n_rules), cast].sum(1))))
        moved = np.abs(new - good).max() if len(new) else 0.0
        good = new
        if moved < 1e-9:
            break
    return LabelModel(float(prior), tuple(map(tuple, table.tolist())), tuple(map(tuple, accuracy.tolist())))


def fit(judged: DataFrame) -> LabelModel:
    """The label model for all rows of a frame with a column ``pattern``."""
    rows = judged.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect()
    return fit_counts([r.pattern for r in rows], [r.n for r in rows])


def _measured(texts: list[bytes]) -> dict[str, list]:
    counts = stats(texts)
    return counts | {"base_failed": base_failed(counts).tolist(), "pattern": patterns(votes(counts)).tolist()}


def measure(documents: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Counts, base check and vote pattern of every text, after the ``keep`` columns."""
    return per_text(documents, text, keep or [], f"{STATS}, base_failed boolean, pattern bigint", _measured)


def judge(documents: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``measure`` with ``p_good``, the posterior, and ``kept``: base passed and p_good >= 0.5.

    The counts, not the texts, are kept in the shared folder between estimating
    and judging, so every text is read once.
    """
    measured = stored(measure(documents, text, keep), "quality")
    model = fit(measured)
    odds = [f"element_at(array({', '.join(f'{w!r}D' for w in ws)}), cast((pattern div {3**r}) % 3 as int) + 1)" for r, ws in enumerate(model.weights)]
    p_good = f"1 / (1 + exp(-({model.prior!r}D + {' + '.join(odds)})))"
    return measured.withColumn("p_good", F.expr(p_good)).withColumn("kept", F.expr(f"not base_failed and p_good >= {KEEP_FROM}"))


def keep_good(documents: DataFrame, text: str = "text") -> DataFrame:
    """The rows that pass, all columns unchanged.

    Texts are measured twice, once for the estimate and once to decide, instead
    of shuffling or storing them.
    """
    model = fit(per_text(documents, text, [], "pattern bigint", lambda t: {"pattern": _measured(t)["pattern"]}))

    def keeps(texts: list[bytes]) -> list[bool]:
        counts = stats(texts)
        passed = model.posterior(patterns(votes(counts))) >= KEEP_FROM
        return (passed & ~base_failed(counts)).tolist()

    return filtered_by_text(documents, text, keeps)
