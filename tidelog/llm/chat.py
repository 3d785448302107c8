"""Chat formatting in budgeted windows that end at turns, with the loss on each answer once.

A turn is written as a start mark, the role, a line feed, the text, an end mark and a
line feed.  A backslash goes into every ``<|`` of a text, and one more into every
``<\\|`` that was there before, so a text never holds a mark and reads back as it was.

A conversation becomes windows of at most ``BUDGET`` tokens.  The running sums of the
tokens of its turns tell how far a window reaches: it starts with the first turn that
is still to come, takes the turns before it that fit into ``HISTORY`` tokens once more,
and goes on up to the last turn that fits.  A system turn that opens the conversation is
repeated before all that.  A turn that leaves no room for the history has less of it;
one that is too long for a window has one of its own, whole, after the system turn.
Only answers that are new in a window are under its loss mask, given as spans of code
points: each answer is a target once.

A conversation of over ``LONG`` tokens is cut by the running sums of its turns, which
are taken range by range, into parts of about that size.  Parts are formatted apart; a
part is handed the system turn and the turns that its first window repeats.

Turns are in the order of turn (null last), role and text; repeated rows are turns of
their own.  A null text or role is the empty one, a null conversation id is a
conversation.  A role may hold anything, line feeds and marks are escaped in it.
Invalid UTF-8 reads as the replacement character.  A text of any length stays whole.
Empty tables give empty results.  Columns other than these four are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import stored, text_bytes

BUDGET, HISTORY, LONG = 512, 128, 1 << 20
SYSTEM, TARGET = "system", "assistant"

#: The marks of a turn (fixed values), and the tokens they cost: both marks, the role, two line feeds.
START, END = "<|im_start|>", "<|im_end|>"
TURN_COST = 5

WORDS = r"[^\x20\x09-\x0D]+"
_MARKED, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")

#: What a row is to its part of a conversation.
_OPENING, _EARLIER, _OWN = 0, 1, 2

WINDOW = "block bigint, window int, text string, loss array<struct<start: int, end: int>>, n_repeated int, n_tokens bigint"


def escaped(text: str) -> str:
    return _MARKED.sub(r"<\\\1|", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def role_line(role: str) -> str:
    return escaped(role.replace("\\", "\\\\").replace("\n", "\\n"))


def role_of(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(line))


def written(role: str, text: str) -> tuple[str, int, int]:
    """A turn in the template, and where its text starts and ends in it."""
    head = f"{START}{role_line(role)}\n"
    body = escaped(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def turns_of(window: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted window."""
    lines = (t.removeprefix(START).split("\n", 1) for t in window.split(f"{END}\n")[:-1])
    return [(role_of(role), unescaped(body)) for role, body in lines]


def spans(costs: list[int], first: int, opening: int, budget: int, history: int) -> Iterator[tuple[int, int, int]]:
    """(repeated from, new from, to) of each window over turns of the given costs.

    New turns begin at ``first``.  The ``opening`` turns at the front, none or one,
    stand before all windows but the one that has them new, and are no history.
    """
    upto = np.array([0, *accumulate(costs)])
    start = first
    while start < len(costs):
        back, room = start, budget
        if start >= opening:
            room = budget - upto[opening]
            back = np.searchsorted(upto, max(upto[start] - history, upto[start + 1] - room))
            back = min(start, max(opening, int(back)))
        end = max(start + 1, int(np.searchsorted(upto, upto[back] + room, side="right")) - 1)
        yield back, start, end
        start = end


def _windows(block: int, kinds: list[int], roles: list[str], texts: list[str], costs: list[int], budget: int, history: int) -> Iterator[dict]:
    """The windows of a part of a conversation, given its rows in order."""
    opening = int(kinds[0] == _OPENING or block == 0 and roles[0] == SYSTEM)
    first = next((i for i, kind in enumerate(kinds) if kind == _OWN), len(kinds))
    for number, (back, start, end) in enumerate(spans(costs, first, opening, budget, history)):
        repeated = [*range(opening if start >= opening else 0), *range(back, start)]
        pieces, loss, length = [], [], 0
        for i in [*repeated, *range(start, end)]:
            piece, from_, to = written(roles[i], texts[i])
            if i >= start and roles[i] == TARGET:
                loss.append({"start": length + from_, "end": length + to})
            pieces.append(piece)
            length += len(piece)
        tokens = sum(costs[i] for i in repeated) + sum(costs[start:end])
        yield {"block": block, "window": number, "text": "".join(pieces), "loss": loss, "n_repeated": len(repeated), "n_tokens": tokens}


def _formatted(turns: DataFrame, conv: str, budget: int, history: int) -> DataFrame:
    """Windows of the rows of ``_turns``; a part of a conversation is one task's, its windows leave in order."""
    order = ["_conv", "block", "_kind", F.col("_turn").asc_nulls_last(), "_role", "_hash"]
    dealt = turns.repartition("_conv", "block").sortWithinPartitions(*order).select("_conv", "block", "_kind", "_role", "_text", "_cost")
    schema = _schema(turns, conv, WINDOW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        key, rows = None, []

        def finished() -> pa.RecordBatch:
            kinds, roles, texts, costs = zip(*rows)
            made = list(_windows(key[1], kinds, roles, texts, costs, budget, history))
            columns = [pa.array([key[0]] * len(made), arrow.field(0).type)]
            columns += [pa.array([w[f.name] for w in made], f.type) for f in list(arrow)[1:]]
            return pa.RecordBatch.from_arrays(columns, names=arrow.names)

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for conv_, block, kind, role, text, cost in zip(*columns):
                if rows and key != (conv_, block):
                    yield finished()
                    rows = []
                key = (conv_, block)
                rows.append((kind, role.decode(errors="replace"), text.decode(errors="replace"), cost))
        if rows:
            yield finished()

    return dealt.mapInArrow(run, schema)


def _schema(turns: DataFrame, conv: str, made: str):
    from pyspark.sql import types as T

    return T.StructType([T.StructField(conv, turns.schema["_conv"].dataType), *T._parse_datatype_string(made).fields])


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str, tokens: Column | None) -> DataFrame:
    """Rows as one part of each conversation; ``tokens`` is an expression over the conversations' columns."""
    tokens = F.regexp_count(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), F.lit(WORDS)) if tokens is None else tokens
    rows = conversations.select(
        F.col(f"`{conv}`").alias("_conv"), F.col(f"`{turn}`").alias("_turn"), text_bytes(role).alias("_role"), text_bytes(text).alias("_text"),
        (F.coalesce(tokens, F.lit(0)).cast("bigint") + TURN_COST).alias("_cost"),
    )
    return rows.withColumns({"_hash": F.xxhash64("_text"), "block": F.lit(0).cast("bigint"), "_kind": F.lit(_OWN)})


def _cut(turns: DataFrame, long_ones: DataFrame, history: int, long: int) -> DataFrame:
    """Rows of long conversations in parts of about ``long`` tokens, with what each part repeats.

    The parts come from ids, hashes and costs alone; texts meet their places by row.
    """
    fixed = stored(turns.drop("block", "_kind").withColumn("_row", F.monotonically_increasing_id()), "long-turns")
    order = [F.col("_turn").asc_nulls_last(), F.col("_role"), F.col("_hash"), F.col("_row")]
    ranges = fixed.select("_conv", "_turn", "_role", "_hash", "_cost", "_row").repartitionByRange(F.col("_conv").asc_nulls_last(), *order)
    ranges = stored(ranges.withColumn("_range", F.spark_partition_id()), "long-ranges")
    before = Window.partitionBy("_conv").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    carried = ranges.groupBy("_conv", "_range").agg(F.sum("_cost").alias("_sum"))
    carried = carried.select(F.col("_conv").alias("_c"), F.col("_range").alias("_r"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_carried"))
    within = Window.partitionBy("_range", "_conv").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    begun = ranges.withColumn("_begun", F.coalesce(F.sum("_cost").over(within), F.lit(0)))
    begun = begun.join(carried, F.expr("_conv <=> _c and _range = _r")).withColumn("_begun", F.col("_begun") + F.col("_carried"))
    lengths = long_ones.select(F.col("_conv").alias("_l"), F.expr(f"(_tokens - 1) div {long}").alias("_last"))
    begun = begun.join(lengths, F.expr("_conv <=> _l")).withColumn("_at", F.expr(f"_begun div {long}"))
    opens = f"(_begun = 0 and _role = cast('{SYSTEM}' as binary))"
    places = F.expr(f"""concat(
        array(struct(_at as block, {_OWN} as _kind)),
        if({opens}, transform(sequence(1L, _last), b -> struct(b as block, {_OPENING} as _kind)), array()),
        if(not {opens} and _begun >= (_at + 1) * {long} - {history}, array(struct(_at + 1 as block, {_EARLIER} as _kind)), array()))""")
    placed = begun.select(F.col("_row").alias("_n"), places.alias("_places"))
    return fixed.join(placed, F.expr("_row = _n")).select("_conv", "_turn", "_role", "_text", "_cost", "_hash", F.inline("_places"))


def _dealt(turns: DataFrame, history: int, long: int) -> tuple[DataFrame, DataFrame | None]:
    """The rows of whole conversations, and those of long ones in parts (None if there are none)."""
    if not 0 <= history <= long:
        raise ValueError("a part must hold the history of the next one")
    sizes = turns.groupBy("_conv").agg(F.sum("_cost").alias("_tokens"))
    long_ones = stored(sizes.filter(F.col("_tokens") > long), "long-conversations")
    if long_ones.isEmpty():
        return turns, None
    match = F.expr("_conv <=> _l")
    ids = long_ones.select(F.col("_conv").alias("_l"))
    return turns.join(ids, match, "left_anti"), _cut(turns.join(ids, match, "left_semi"), long_ones, history, long)


def windows(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    tokens: Column | None = None,
    budget: int = BUDGET,
    history: int = HISTORY,
    long: int = LONG,
) -> DataFrame:
    """``conv`` and the columns of WINDOW, one row for each window; (block, window) is their order.

    ``n_repeated`` turns at the front stand in an earlier window too.  ``loss`` are the
    spans of ``text``, in code points, that are targets.  ``tokens`` counts the tokens
    of a turn's text, words unless given.
    """
    whole, cut = _dealt(_turns(conversations, conv, turn, role, text, tokens), history, long)
    made = _formatted(whole, conv, budget, history)
    return made if cut is None else made.unionByName(_formatted(cut, conv, budget, history))


DIGEST = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_windows bigint"


class _Reader:
    """What the windows of a conversation say, one after the other."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.n_windows = 0

    def read(self, text: str, loss: list[dict], n_repeated: int) -> None:
        for role, body in turns_of(text)[n_repeated:]:
            self.turns.update(f"{role}\n{body}\n".encode())
            self.n_turns += 1
        for span in loss:
            target = unescaped(text[span["start"] : span["end"]])
            self.loss.update(target.encode())
            self.loss_chars += len(target)
        self.chars += len(text)
        self.n_windows += 1

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.n_windows


def _read(made: DataFrame, conv: str) -> DataFrame:
    """Digests of conversations whose windows come in order; a hash takes a conversation's text in one go, window by window."""
    schema = _schema(made.select(F.col(f"`{conv}`").alias("_conv")), conv, DIGEST)
    source = made.select(F.col(f"`{conv}`"), "text", "loss", "n_repeated")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        key, reader = None, None
        for batch in batches:
            out = []
            for conv_, text, loss, n_repeated in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if reader and key != conv_:
                    out.append((key, *reader.row()))
                if not reader or key != conv_:
                    key, reader = conv_, _Reader()
                reader.read(text, loss, n_repeated)
            yield _table(out, arrow)
        if reader:
            yield _table([(key, *reader.row())], arrow)

    return source.mapInArrow(run, schema)


def _table(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)], names=arrow.names)


def read_back(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    tokens: Column | None = None,
    budget: int = BUDGET,
    history: int = HISTORY,
    long: int = LONG,
) -> DataFrame:
    """``conv`` and the columns of DIGEST: what the windows of each conversation hold, read from their text and masks.

    Whole conversations are read by the task that formats them; windows of long ones
    are brought together again in their order.
    """
    whole, cut = _dealt(_turns(conversations, conv, turn, role, text, tokens), history, long)
    read = _read(_formatted(whole, conv, budget, history), conv)
    if cut is None:
        return read
    parts = _formatted(cut, conv, budget, history)
    return read.unionByName(_read(parts.repartition(F.col(f"`{conv}`")).sortWithinPartitions(F.col(f"`{conv}`"), "block", "window"), conv))
