"""Packing of documents into windows of a fixed length, online, by the sum-of-squares rule.

A document's whole windows leave at once. Its rest goes to the fill level that makes the sum over levels of the
squared number of windows at that level least; the level array holds those numbers. Pieces of windows that are open
when a partition ends meet those of other partitions, in groups of a bounded size, and are placed again by the same
rule, larger ones first. Only what is open then is cut and joined, so that a group leaves one window with padding at most.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written

#: Pieces of open windows that are placed together, about; each holds less ids than a window.
OPEN_PIECES = 8_000
#: Sequences of such pieces are numbered from here.
_LATER = 1 << 61
_ENCODERS: dict = {}


def encoder(ranks_path: str, tokenizer_path: str):
    """A function from a text to ids. Both files hold one vocabulary; the first is for the faster library.

    A text that spells a special token goes to the other library, which is the definition.
    """
    key = (ranks_path, tokenizer_path)
    if key not in _ENCODERS:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        slow = Tokenizer.from_file(tokenizer_path)
        special = [t.content for t in slow.get_added_tokens_decoder().values()]

        def encode(text: str) -> list[int]:
            if any(s in text for s in special):
                return slow.encode(text, add_special_tokens=False).ids
            return fast.encode_ordinary(text)

        _ENCODERS[key] = encode
    return _ENCODERS[key]


class Packer:
    """Windows of `size` ids; place() gives the pieces that leave, as (doc, start, ids, doc_tokens, window, offset)."""

    def __init__(self, size: int, first: int):
        self.size, self.next = size, first
        self.levels = np.zeros(size + 1, dtype=np.int64)
        self.open: list[list[list]] = [[] for _ in range(size + 1)]  # by level, windows as lists of pieces

    def _new(self) -> int:
        self.next += 1
        return self.next - 1

    def place(self, doc, ids: np.ndarray) -> list[tuple]:
        out, n, size = [], len(ids), self.size
        for at in range(0, n - n % size, size):
            out.append((doc, at, ids[at : at + size], n, self._new(), 0))
        if rest := n % size:
            out += self._put((doc, n - rest, ids[n - rest :], n), rest)
        return out

    def _put(self, piece: tuple, s: int) -> list[tuple]:
        size, levels = self.size, self.levels
        fits = np.flatnonzero(levels[: size - s + 1])
        after = fits + s
        change = 2 * np.where(after < size, levels[after], 0) + (after < size) - 2 * levels[fits] + 1
        level = 0
        if len(fits) and change.min() <= 2 * levels[s] + 1:  # a new window would stand at level s
            level = int(fits[len(fits) - 1 - int(np.argmin(change[::-1]))])
        pieces = self.open[level].pop() if level else []
        levels[level] -= bool(level)
        pieces.append(piece)
        if level + s == size:
            return list(self._closed(pieces))
        levels[level + s] += 1
        self.open[level + s].append(pieces)
        return []

    def _closed(self, pieces: list) -> Iterator[tuple]:
        window, offset = self._new(), 0
        for doc, start, ids, n in pieces:
            yield (doc, start, ids, n, window, offset)
            offset += len(ids)

    def left(self) -> Iterator[tuple]:
        """The pieces of open windows, without a window."""
        for windows in self.open:
            for pieces in windows:
                for doc, start, ids, n in pieces:
                    yield (doc, start, ids, n, None, None)
        self.levels[:], self.open = 0, [[] for _ in range(self.size + 1)]

    def again(self, pieces: list[tuple]) -> Iterator[tuple]:
        """Places pieces by the rule, larger ones first."""
        for piece in sorted(pieces, key=lambda p: -len(p[2])):
            yield from self._put(piece, len(piece[2]))

    def drain(self) -> Iterator[tuple]:
        """Fills up what is open with what is open, fullest first, cutting pieces where a window is full."""
        held, room = [], self.size
        for level in range(self.size, 0, -1):
            for pieces in self.open[level]:
                for doc, start, ids, n in pieces:
                    while len(ids):
                        part, ids = ids[:room], ids[room:]
                        held.append((doc, start, part, n))
                        start, room = start + len(part), room - len(part)
                        if not room:
                            yield from self._closed(held)
                            held, room = [], self.size
        if held:
            yield from self._closed(held)
        self.levels[:], self.open = 0, [[] for _ in range(self.size + 1)]


_NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def _batch(pieces: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    doc, start, ids, n, window, offset = zip(*pieces)
    long = lambda x: pa.array(x, pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(doc, kind), long(start), long([len(x) for x in ids]), pa.array([x.tobytes() for x in ids], pa.binary()), long(n), long(window), long(offset)], names=_NAMES)


def _pack(size: int, end: int, ranks_path: str, tokenizer_path: str):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks_path, tokenizer_path)
        packer, out, kind = Packer(size, TaskContext.get().partitionId() << 40), [], pa.int64()
        for batch in batches:
            kind = batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                out += packer.place(doc, np.array(encode(text.as_py() or "") + [end], dtype="<u4"))
                if len(out) >= 2_000:
                    yield _batch(out, kind)
                    out = []
        out += packer.left()
        for a in range(0, len(out), 2_000):
            yield _batch(out[a : a + 2_000], kind)

    return pack


def _place(size: int):
    """Pieces of open windows, a group of them, to pieces in sequences."""

    def place(key: tuple, table: pa.Table) -> pa.Table:
        packer = Packer(size, _LATER + (key[0].as_py() << 40))
        columns = [table.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")]
        pieces = [(doc, start, np.frombuffer(ids, "<u4"), n) for doc, start, ids, n in zip(*columns)]
        out = [*packer.again(pieces), *packer.drain()]
        return pa.Table.from_batches([_batch(out, table.schema.field("doc_id").type)])

    return place


def pack(docs: DataFrame, ranks_path: str, tokenizer_path: str, size: int = 1024, end: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Puts the ids of each text, and then the id `end`, into sequences of at most `size` ids.

    Returns a row per piece: doc_id, start (ids of its document before it), length, ids (unsigned 32-bit, little
    endian), doc_tokens, sequence_id, offset. Every id lies in one piece; offsets of a sequence have no gaps.
    sequence_id starts with the number of the partition, or of the group of open windows. What is shuffled is pieces of
    open windows, some hundreds of windows of a partition. A null or empty text is the id `end` alone; a null doc_id
    stays null; equal rows are packed one by one; an empty table gives no pieces. Other columns are not read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    placed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(_pack(size, end, ranks_path, tokenizer_path), schema)
    placed = written(placed, "pieces")
    rest = placed.filter("sequence_id is null")
    groups = -(-rest.count() // OPEN_PIECES)
    out = placed.filter("sequence_id is not null")
    if groups:
        # dealt by place in the table, so that equal rows are spread too
        rest = written(rest.withColumn("deal", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))), "open-pieces")
        out = out.unionAll(rest.groupBy("deal").applyInArrow(_place(size), schema))
    return out.withColumnRenamed("doc_id", doc_id)
