"""Token ids in Arrow files of equal-length sequences.

Documents are encoded in ascending id order and their ids, each document's end id
included, form one long stream.  The stream is cut into blocks of documents, one
Arrow IPC file each: record batches with the columns ``ids``
(``fixed_size_list<uint16>[SEQUENCE]``, uint32 for a vocabulary above 65,536) and
``mask`` (``fixed_size_list<bool>[SEQUENCE]``, false for padding, which only ends a
file).  A fixed-size list has no offsets, so sequence i of a memory-mapped file is a
slice of its buffer, and any run of ids can be read without copying the file.

Blocks are cut at quantiles of the id, so no task needs a whole order.  A task
streams a block into its file, RECORD sequences at a time; a file is written under a
name of its own and renamed when complete, so a repeated task leaves one good file.

Null text: like an empty one, only its end id.  Bytes that are no UTF-8 are read as the
replacement character.  Null ids come first; rows with one
id are ordered by text.  An empty table gives no files and an empty index.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, repeat
from operator import contains, eq

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.llm.byte_bpe import SPACE, chunks
from tidelog.llm.common import held, slices, stored, valid_text
from tidelog.workspace import new_dir

SEQUENCE, RECORD, END_ID = 2_048, 256, 2
BLOCK_ROWS, MAX_BLOCKS = 500, 10_000
_MEMO, _JOINED = 800_000, 256
#: Texts whose chunks a task looks up at once, and texts whose ids it gathers at once.
_TEXTS, _GATHERED = 5_000, 500
_ANY_SPACE = re.compile(f"[{SPACE}]")
#: How a byte-level vocabulary writes a space (fixed value).
_SPACE_MARK = "Ġ"


_OTHER_SPACE = [c for c in SPACE if c != " "]


def _even(text: str, others: list[str]) -> bool:
    """Whether every space stands alone between words, so that the text can be cut at each; ``others`` has its other white space."""
    if "  " in text or text[:1] == " " or text[-1:] == " ":
        return False
    return not any(c in text and (f" {c}" in text or f"{c} " in text) for c in others)


class LibraryEncoder:
    """Encodes with the tokenizers library, each distinct chunk between single spaces once.

    No pre-token of a byte-level tokenizer crosses such a space, so the ids are
    those of the whole text.  The library finds its added tokens before it
    pre-tokenizes, so a text that holds one is encoded whole.  Chunks get numbers, and
    the ids of all of them lie in one array; those of a text are gathered from it.  Each
    distinct chunk of a batch is looked up once.  At _MEMO chunks the ones met once are
    forgotten, or all if that is not enough.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # chunks set side by side must not make an added token
        self.joined = 1 if any(_ANY_SPACE.search(a) for a in self.added) else _JOINED
        size = self.tokenizer.get_vocab_size()
        self.kind = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.after_space = np.array([(self.tokenizer.id_to_token(i) or "").startswith(_SPACE_MARK) for i in range(size)])
        self.chunks, self.ids = pa.array([], pa.string()), np.zeros(0, self.kind)
        self.start, self.length, self.uses = (np.zeros(0, np.int64) for _ in range(3))

    def _keep(self, numbers: np.ndarray) -> None:
        """Forget all chunks but those of the given numbers."""
        self.chunks = self.chunks.take(pa.array(numbers))
        ids = [self.ids[a : a + n] for a, n in zip(self.start[numbers].tolist(), self.length[numbers].tolist())]
        self.ids = np.concatenate([np.zeros(0, self.kind), *ids])
        self.length = self.length[numbers]
        self.start = np.cumsum(self.length) - self.length
        self.uses = np.zeros(len(numbers), np.int64)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_chunks(self, new: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of chunks, each with a space before it, how many each has, and at which place of these it is.

        Chunks without a space, and without other white space at their ends, are encoded
        many in one text: an id that begins with a space then begins a chunk.
        """
        fits = np.fromiter(map(eq, new, map(str.strip, new)), bool, len(new))
        fits &= ~np.fromiter(map(contains, new, repeat(" ")), bool, len(new))
        plain, alone = np.flatnonzero(fits).tolist(), np.flatnonzero(~fits).tolist()
        groups = [plain[i : i + self.joined] for i in range(0, len(plain), self.joined)]
        ids, lengths, order = [], [], []
        for group, found in zip(groups, self._encode([" " + " ".join(map(new.__getitem__, g)) for g in groups])):
            starts = np.flatnonzero(self.after_space[found])
            if len(starts) == len(group) and starts[0] == 0:
                ids.append(found)
                lengths.append(np.diff(starts, append=len(found)))
                order += group
            else:
                alone += group
        rest = self._encode([" " + new[i] for i in alone])
        place = np.argsort(np.array(order + alone, np.int64))
        return np.concatenate([np.zeros(0, self.kind), *ids, *rest]), np.concatenate([*lengths, np.array([len(r) for r in rest], np.int64)]), place

    def _numbered(self, chunks_: pa.Array) -> np.ndarray:
        """The numbers of all chunks, in order; new ones are encoded."""
        if len(self.chunks) > _MEMO:
            again = np.flatnonzero(self.uses > 1)
            self._keep(again if len(again) <= _MEMO // 2 else again[:0])
        coded = chunks_.dictionary_encode()
        places = coded.indices.to_numpy()
        numbers = pc.index_in(coded.dictionary, value_set=self.chunks).fill_null(-1).to_numpy().astype(np.int64)
        fresh = numbers < 0
        if fresh.any():
            new = coded.dictionary.filter(pa.array(fresh))
            numbers[fresh] = len(self.chunks) + np.arange(len(new))
            ids, lengths, place = self._encode_chunks(new.to_numpy(zero_copy_only=False).tolist())
            starts = len(self.ids) + np.cumsum(lengths) - lengths
            self.chunks, self.ids = pa.concat_arrays([self.chunks, new]), np.concatenate([self.ids, ids])
            self.start, self.length = np.concatenate([self.start, starts[place]]), np.concatenate([self.length, lengths[place]])
            self.uses = np.concatenate([self.uses, np.zeros(len(place), np.int64)])
        self.uses[numbers] += np.bincount(places, minlength=len(numbers))
        return numbers[places]

    def _parts(self, texts: list[str]) -> tuple[list[int], list[str], pa.Array, np.ndarray]:
        """The texts in an order of their own; of each in that order the first chunk; their other chunks and how many each has."""
        whole = "\n".join(texts)
        added, others = [a for a in self.added if a in whole], [c for c in _OTHER_SPACE if c in whole]
        plain = [not any(a in t for a in added) for t in texts] if added else [True] * len(texts)
        even = [i for i, t in enumerate(texts) if plain[i] and _even(t, others)]
        rest = sorted(set(range(len(texts))).difference(even))
        split = pc.split_pattern(pa.array(map(texts.__getitem__, even), pa.string()), " ")
        lengths, found = pc.list_value_length(split).to_numpy().astype(np.int64), split.flatten()
        first = np.zeros(len(found), bool)
        first[np.cumsum(lengths) - lengths] = True
        parts = [chunks(texts[i]) if plain[i] else [texts[i]] for i in rest]
        firsts = found.filter(pa.array(first)).to_pylist() + [p.pop(0) for p in parts]
        later = pa.concat_arrays([found.filter(pa.array(~first)), pa.array(chain.from_iterable(parts), pa.string())])
        return even + rest, firsts, later, np.concatenate([lengths - 1, np.array([len(p) for p in parts], np.int64)])

    def encode(self, texts: list[str], end: int | None) -> list[np.ndarray]:
        """The ids of each text, followed by ``end`` if given."""
        order, firsts, later, sizes = self._parts(texts)
        numbers, first_ids = self._numbered(later), self._encode(firsts)
        ends, tail = np.cumsum(sizes), np.array([] if end is None else [end], self.kind)
        out: list[np.ndarray] = [tail] * len(texts)
        for at in range(0, len(order), _GATHERED):
            some = slice(at, at + _GATHERED)
            begin = ends[at] - sizes[at]
            own = numbers[begin : ends[some][-1]]
            lengths = self.length[own]
            upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])
            # each chunk's ids lie in one piece: its place in the array, less its place in the texts, plus 0, 1, 2 ...
            ids = self.ids[np.repeat(self.start[own] - upto[:-1], lengths) + np.arange(upto[-1])]
            cuts = upto[np.concatenate([[0], ends[some] - begin])].tolist()
            for i, first, a, b in zip(order[some], first_ids[some], cuts, cuts[1:]):
                out[i] = np.concatenate([first, ids[a:b], tail])
        return out


def sequence_schema(kind: np.dtype) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(kind), SEQUENCE)), ("mask", pa.list_(pa.bool_(), SEQUENCE))])


class SequenceWriter:
    """Appends runs of ids to one Arrow file; holds one record batch at most."""

    def __init__(self, sink, kind: np.dtype):
        self.kind, self.schema = kind, sequence_schema(kind)
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.waiting: list[np.ndarray] = []
        self.size = self.total = 0

    def append(self, ids: np.ndarray) -> int:
        """The place of the run in the file."""
        start, batch = self.total, SEQUENCE * RECORD
        self.total += len(ids)
        self.waiting.append(ids)
        self.size += len(ids)
        while self.size >= batch:
            whole = np.concatenate(self.waiting)
            self._write(whole[:batch], batch)
            self.waiting, self.size = [whole[batch:]], self.size - batch
        return start

    def _write(self, ids: np.ndarray, used: int) -> None:
        mask = np.arange(len(ids)) < used
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(c), SEQUENCE) for c in (ids, mask)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        if self.size:
            ids = np.concatenate(self.waiting)
            self._write(np.concatenate([ids, np.zeros(-len(ids) % SEQUENCE, self.kind)]), len(ids))
        self.writer.close()


class SequenceFile:
    """Random access to a file: sequences, masks and runs of ids, without copying where a run lies in one batch."""

    def __init__(self, source):
        self.reader = pa.ipc.open_file(source)
        self.held: tuple[int, pa.RecordBatch] | None = None

    def _batch(self, i: int) -> pa.RecordBatch:
        if self.held is None or self.held[0] != i:
            self.held = (i, self.reader.get_batch(i))
        return self.held[1]

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence ``i``."""
        batch, at = self._batch(i // RECORD), i % RECORD
        return tuple(batch.column(c)[at].values.to_numpy(zero_copy_only=c == 0) for c in (0, 1))

    def run(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ``n`` ids from ``start`` on, in one part for each batch they touch."""
        size = SEQUENCE * RECORD
        while n > 0:
            at = start % size
            ids = self._batch(start // size).column(0).flatten().to_numpy()
            mask = self._batch(start // size).column(1).flatten()
            part = ids[at : at + n]
            # masks only end a file, so the last id of the part decides
            if not len(part) or not mask[at + len(part) - 1].as_py():
                raise ValueError("run reaches into the padding")
            yield part
            start, n = start + len(part), n - len(part)


def _place(uri: str) -> tuple[pa.fs.FileSystem, str]:
    import pyarrow.fs as fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write(documents: DataFrame, tokenizer: str, folder: str, text: str = "text", id_: str = "doc_id", end: int = END_ID) -> DataFrame:
    """Write the files below ``folder`` (shared by all executors); returns the index, itself written there.

    Index: ``id_, block, path, first`` (place in the file), ``n_tokens`` and
    ``start``, the ids of all documents before it.
    """
    ids = documents.select(F.col(id_).cast("bigint").alias("_id"))
    parts = max(1, min(MAX_BLOCKS, ids.count() // BLOCK_ROWS))
    cuts = ids.agg(F.percentile_approx("_id", [i / parts for i in range(1, parts)], 100_000)).first()[0] if parts > 1 else []
    starts = np.array(sorted(set(cuts or [])), np.int64)

    @F.pandas_udf("int")
    def block_of(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, values.to_numpy(), side="right").astype(np.int32))

    source = documents.select(F.col(id_).cast("bigint").alias("_id"), valid_text(text).alias("_text"))
    tasks = min(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), len(starts) + 1)
    dealt = source.withColumn("_block", F.when(F.col("_id").isNull(), 0).otherwise(block_of(F.coalesce("_id", F.lit(0))))).repartition(max(tasks, 1), "_block")
    ordered = dealt.sortWithinPartitions("_block", F.col("_id").asc_nulls_first(), "_text")
    schema = f"`{id_}` bigint, block int, path string, first bigint, n_tokens bigint"
    names = [id_, "block", "path", "first", "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = held(("tokenizers", tokenizer), lambda: LibraryEncoder(tokenizer))
        system, root = _place(folder)
        system.create_dir(root, recursive=True)
        block = writer = sink = None
        made: list[str] = []

        def close() -> None:
            if writer is not None:
                writer.close()
                sink.close()
                system.move(made[0], made[1])

        for batch in batches:
            for some in slices(batch, rows=_TEXTS):
                text_, own, blocks = some.columns
                paths, firsts, sizes = [], [], []
                for number, ids_ in zip(blocks.to_pylist(), encoder.encode(text_.to_pylist(), end)):
                    if number != block:
                        close()
                        block = number
                        name = f"block-{number:05d}.arrow"
                        made = [f"{root}/.{name}.{uuid.uuid4().hex}", f"{root}/{name}"]
                        sink = system.open_output_stream(made[0])
                        writer = SequenceWriter(sink, encoder.kind)
                    paths.append(f"{folder}/{name}")
                    firsts.append(writer.append(ids_))
                    sizes.append(len(ids_))
                columns = [own, blocks, pa.array(paths, pa.string()), pa.array(firsts, pa.int64()), pa.array(sizes, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        close()

    index = stored(ordered.select("_text", "_id", "_block").mapInArrow(run, schema), "token-index")
    totals = index.groupBy("block").agg(F.sum("n_tokens").alias("_n"))
    # one row for each block, at most MAX_BLOCKS
    before = totals.select("block", F.coalesce(F.sum("_n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return index.join(F.broadcast(before), "block").select(id_, "block", "path", "first", "n_tokens", (F.col("_before") + F.col("first")).alias("start"))


def read(index: DataFrame, id_: str = "doc_id") -> DataFrame:
    """``id_, start, n_tokens`` and ``ids_crc32`` of every indexed document, from the files.

    Each task opens the files of its blocks and looks the runs up; the checksum is
    of the ids as little-endian unsigned 32-bit integers.
    """
    schema = f"`{id_}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened: tuple[str, SequenceFile] | None = None
        for frame in frames:
            sums = []
            for path, first, n in zip(frame["path"], frame["first"], frame["n_tokens"]):
                if opened is None or opened[0] != path:
                    system, name = _place(path)
                    local = system.type_name == "local"
                    opened = (path, SequenceFile(pa.memory_map(name) if local else system.open_input_file(name)))
                crc = 0
                for part in opened[1].run(first, n):
                    crc = zlib.crc32(np.ascontiguousarray(part, "<u4"), crc)
                sums.append(crc)
            yield frame[[id_, "start", "n_tokens"]].assign(ids_crc32=sums)

    # neighbours of one file already lie together in the index
    return index.select(id_, "path", "first", "n_tokens", "start").mapInPandas(run, schema)


def token_folder(spark: SparkSession) -> str:
    """A new folder in the place that all executors share."""
    return new_dir(spark, "tokens")
