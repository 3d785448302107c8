"""Byte-level BPE encoding and decoding with two-tier lookup.

A minimal perfect hash over the vocabulary resolves a whole pre-token with one
comparison.  A pre-token that is not in the vocabulary is merged from its bytes:
they form a linked list, a heap yields the pair of lowest rank (leftmost first), and
a merge updates the two pairs beside it, so a pre-token of n bytes costs n log n.

Ranks come from a file of base64 tokens and ranks; the driver reads it and ships
the tables, a few MB for any vocabulary in use.  Null text: like an empty one, no
ids.  Texts are encoded whole, pre-token by pre-token, however long; equal texts
give equal ids.  Special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import held, per_text

_MIX, _SPREAD, _WORD = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0xFFFFFFFFFFFFFFFF
_MEMO, _DECODED_ROWS = 400_000, 500
#: White space of the pre-token pattern (Unicode property White_Space), fixed values.
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
#: A space beside other white space or at an end: there words cannot be cut apart by the space alone.
_UNEVEN = re.compile(f"[{SPACE}] | [{SPACE}]|^ | $")
_CUT = re.compile(f"(?<=[^{SPACE}]) (?=[^{SPACE}])")


def chunks(text: str) -> list[str]:
    """The text cut at every single space between words; all chunks but the first had a space before them.

    No pre-token crosses such a cut, since the space belongs to what follows it.
    """
    return text.split(" ") if _UNEVEN.search(text) is None else _CUT.split(text)


def read_ranks(path: str) -> list[bytes]:
    """Tokens in the order of their ranks, which must be 0, 1, 2 …"""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, filter(None, map(bytes.strip, lines)))}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"ranks of {path} have gaps")
    return [ranks[i] for i in range(len(ranks))]


class PerfectHash:
    """Maps each of n keys to its own slot of n slots; other keys to any slot, where they are told apart.

    Keys fall into buckets; each bucket stores the first displacement that sends
    all its keys to free slots.  Buckets of one key store the slot itself.
    """

    def __init__(self, keys: list[bytes]):
        self.n = max(len(keys), 1)
        self.buckets = self.n // 3 + 1
        self.key_at: list[bytes | None] = [None] * self.n
        self.index_at = array("q", [-1]) * self.n
        self.shift = array("q", [0]) * self.buckets
        members: list[list[tuple[int, int]]] = [[] for _ in range(self.buckets)]
        for i, key in enumerate(keys):
            hashed = xxhash.xxh64_intdigest(key)
            members[hashed % self.buckets].append((hashed, i))
        taken = bytearray(self.n)
        free = 0
        for bucket in sorted(range(self.buckets), key=lambda b: -len(members[b])):
            found = members[bucket]
            if len(found) > 1:
                if len({h for h, _ in found}) < len(found):
                    raise ValueError("repeated key")
                d = 1
                while True:
                    slots = [self._slot(h, d) for h, _ in found]
                    if len(set(slots)) == len(slots) and not any(taken[s] for s in slots):
                        break
                    d += 1
            elif found:
                free = taken.index(0, free)
                slots, d = [free], -free
            else:
                continue
            self.shift[bucket] = d
            for slot, (_, i) in zip(slots, found):
                taken[slot] = 1
                self.key_at[slot], self.index_at[slot] = keys[i], i

    def _slot(self, hashed: int, d: int) -> int:
        mixed = ((hashed ^ (d * _MIX & _WORD)) * _SPREAD) & _WORD
        return (mixed >> 29) % self.n

    def get(self, key: bytes) -> int:
        """The index of the key, or -1."""
        hashed = xxhash.xxh64_intdigest(key)
        d = self.shift[hashed % self.buckets]
        slot = self._slot(hashed, d) if d > 0 else -d
        return self.index_at[slot] if self.key_at[slot] == key else -1


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece by lowest-rank merges; every single byte must have a rank."""
    n = len(piece)
    after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    rank_of = ranks.get
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank_of(piece[i : i + 2])) is not None]
    heapify(heap)
    while heap:
        _, i, stop = heappop(heap)
        j = after[i] if end[i] else n
        # outdated: the left part is gone or grown, or the right one is
        if not end[i] or j >= n or end[j] != stop:
            continue
        end[i], end[j] = stop, 0
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := rank_of(piece[i : end[k]])) is not None:
                heappush(heap, (r, i, end[k]))
        h = before[i]
        if h >= 0 and (r := rank_of(piece[h:stop])) is not None:
            heappush(heap, (r, h, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = after[i]
    return out


class Encoder:
    """Encodes texts; remembers the ids of the first chunks and merged pre-tokens it met, up to a bound.

    Frequent ones come early, so a full memo is left as it is.
    """

    def __init__(self, tokens: list[bytes], whole: PerfectHash, pattern: str):
        self.tokens, self.whole = tokens, whole
        self.ranks = {t: i for i, t in enumerate(tokens)}
        self.pieces = regex.compile(pattern).findall
        self.memo: dict[str, bytes] = {}
        self.merged: dict[str, list[int]] = {}

    def chunk(self, text: str) -> np.ndarray:
        out: list[int] = []
        for piece in self.pieces(text):
            ids = self.merged.get(piece)
            if ids is None:
                raw = piece.encode()
                found = self.whole.get(raw)
                if found >= 0:
                    out.append(found)
                    continue
                ids = merge(raw, self.ranks)
                if len(self.merged) < _MEMO // 4:
                    self.merged[piece] = ids
            out += ids
        return np.array(out, np.int32)

    def encode(self, text: str) -> np.ndarray:
        parts, memo = chunks(text), self.memo
        found = list(map(memo.get, parts))
        found[0] = self.chunk(parts[0]).tobytes()
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    part = parts[i]
                    found[i] = memo.get(part) or self.chunk(" " + part).tobytes()
                    if len(memo) < _MEMO:
                        memo[part] = found[i]
        return np.frombuffer(b"".join(found), np.int32)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, list(ids)))


def encode(documents: DataFrame, ranks: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``ids array<int>`` of every text, after the ``keep`` columns; ``ranks`` is the path of the rank file."""
    tokens = read_ranks(ranks)
    whole = PerfectHash(tokens)
    token = ("bpe", ranks, pattern)

    def work(texts: list[bytes]) -> dict[str, list]:
        encoder = held(token, lambda: Encoder(tokens, whole, pattern))
        return {"ids": [encoder.encode(t.decode()) for t in texts]}

    return per_text(documents, text, keep or [], "ids array<int>", work)


def decode(encoded: DataFrame, ranks: str, ids: str = "ids", made: str = "decoded") -> DataFrame:
    """All columns of the frame, and ``made``: the bytes that the ids stand for (null ids: no bytes)."""
    tokens = read_ranks(ranks)
    position = encoded.columns.index(ids)
    schema = T.StructType([*encoded.schema.fields, T.StructField(made, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.empty(len(tokens), object)
        table[:] = tokens
        for batch in batches:
            for start in range(0, batch.num_rows, _DECODED_ROWS):
                part = batch.slice(start, _DECODED_ROWS)
                lists = part.column(position).fill_null([]) if part.column(position).null_count else part.column(position)
                flat, ends = lists.flatten().to_numpy(), np.cumsum([0, *lists.value_lengths().to_pylist()]).tolist()
                found = [b"".join(table[flat[a:b]].tolist()) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.binary())], names=schema.names)

    return encoded.mapInArrow(run, schema)


def id_digest(ids: str = "ids"):
    """sha256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), ",").cast("binary"), 256)
