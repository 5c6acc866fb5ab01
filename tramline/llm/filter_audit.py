"""Audit of how filters overlap, in every order in which they can be applied.

Four filters look at a text alone; the fifth asks whether a smaller id has the same text. For this, texts are dealt to
ranges by prefixes, which are as long as it takes to tell neighbours apart, and are put whole into compressed tries that hold the least id where a
text ends. What is left of a row then is a mask of the filters that it fails; masks are counted and applied to the orders.
"""

from __future__ import annotations

import itertools
import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import partitions, written

FILTERS = "ABCDE"
#: Bytes of text in a trie, on average; ranges and tasks at most.
RANGE_BYTES, RANGES = 16 << 20, 20_000
#: Samples per range, and bytes of a prefix at most; texts that share more are told apart by their crc32.
OVERSAMPLE, PREFIX = 8, 256
#: Bytes of text whose copies are settled where they lie.
CHUNK_BYTES = 16 << 20
_ROW = 64
_UPPER, _MARKS, _INNER = bytes(range(65, 91)), b"#$%&*|", bytes(range(0x80, 0xC0))


def mask(text: bytes) -> int:
    """Bits of the filters A to D that a text in UTF-8 fails."""
    words = text.split()
    upper, marks = len(text) - len(text.translate(None, _UPPER)), len(text) - len(text.translate(None, _MARKS))
    points = len(text.translate(None, _INNER))
    return (len(words) < 200) | (100 * len(set(words)) < 50 * len(words)) << 1 | (100 * upper > 3 * points) << 2 | (marks > 0) << 3


class Node:
    """A node of a compressed trie: the bytes that lead to it, its children by their first byte, and what ends here."""

    __slots__ = ("label", "children", "least", "rows")

    def __init__(self, label: bytes):
        self.label, self.children, self.least, self.rows = label, {}, None, None


def _common(label: bytes, text: bytes, at: int) -> int:
    """How many bytes of a label that is not there as a whole are at a place of a text."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if text.startswith(label[:mid], at) else (low, mid - 1)
    return low


def insert(root: Node, text: bytes) -> Node:
    """The node at which a text ends; an edge is split where it has to be."""
    node, at = root, 0
    while at < len(text):
        child = node.children.get(text[at])
        if child is None:
            node.children[text[at]] = child = Node(text[at:])
            return child
        if not text.startswith(child.label, at):
            k = _common(child.label, text, at)
            middle = Node(child.label[:k])
            child.label = child.label[k:]
            middle.children[child.label[0]] = child
            node.children[text[at]] = child = middle
        node, at = child, at + len(child.label)
    return node


def settle(node: Node, key, row) -> list:
    """Puts a row (with a key that is not null) at its text's end. Returns rows that are now known to have a smaller one with the same text."""
    if node.rows is None or key < node.least:
        gone, node.least, node.rows = node.rows or [], key, [row]
        return gone
    if key == node.least:
        node.rows.append(row)
        return []
    return [row]


def ends(root: Node) -> Iterator[tuple[bytes, Node]]:
    """All texts of a trie with the nodes at which they end."""
    stack = [(b"", root)]
    while stack:
        before, node = stack.pop()
        text = before + node.label
        if node.rows is not None:
            yield text, node
        stack.extend((text, child) for child in node.children.values())


def _texts(column: pa.Array) -> list[bytes]:
    return [v or b"" for v in column.cast(pa.large_binary()).to_pylist()]


def _sample(step: float):
    """Of each chunk's distinct texts in order, one in every `step` bytes, cut after the first byte that tells it from the one before it."""

    def prefixes(texts: set[bytes], draw: np.random.Generator) -> list[bytes]:
        order, out, at, before = sorted(texts), [], draw.random() * step, b""
        for text in order:
            at -= len(text) + _ROW
            if at < 0:
                out.append(text[: min(PREFIX, _common(text, before, 0) + 1)])
                at += step * (1 + math.floor(-at / step))
            before = text
        return out

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw, held, size = np.random.default_rng(TaskContext.get().partitionId()), set(), 0
        for batch in batches:
            for text in _texts(batch.column(0)):
                if text not in held:
                    held.add(text)
                    size += len(text) + _ROW
            if size >= CHUNK_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(prefixes(held, draw), pa.binary())], names=["prefix"])
                held, size = set(), 0
        yield pa.RecordBatch.from_arrays([pa.array(prefixes(held, draw), pa.binary())], names=["prefix"])

    return sample


def slots(sample: list[bytes], ranges: int, wanted: int) -> tuple[list[bytes], list[int]]:
    """Bounds of ranges by prefix, and the first slot of each range (and the number of slots): a range with many samples has several."""
    sample = sorted(sample)
    bounds = sorted({sample[k * len(sample) // ranges] for k in range(1, ranges)}) if sample else []
    counts = np.bincount([bisect_right(bounds, p) for p in sample], minlength=len(bounds) + 1)
    each = np.maximum(1, np.round(counts * wanted / max(1, len(sample)))).astype(int)
    return bounds, [0, *np.cumsum(each).tolist()]


_KEPT = "doc_id {kind}, langs array<string>, mask int, text binary, slot int"


def _combine(bounds: list[bytes], first: list[int], kind: pa.DataType):
    """Rows to their masks. Of equal texts of a chunk, only rows with the least id go on with their text; the rest are settled here."""
    schema = pa.schema([("doc_id", kind), ("langs", pa.list_(pa.string())), ("mask", pa.int32()), ("text", pa.binary()), ("slot", pa.int32())])
    duplicate = 1 << FILTERS.index("E")

    def slot(text: bytes) -> int:
        r = bisect_right(bounds, text)
        return first[r] + zlib.crc32(text) % (first[r + 1] - first[r])

    def batches_of(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(rows), 1_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i : i + 1_000]), schema)], schema=schema)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root, size, turn = Node(b""), 0, TaskContext.get().partitionId()
        for batch in batches:
            done = []
            for key, lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _texts(batch.column(2))):
                bits, turn = mask(text), turn + 1
                if key is None:
                    done.append((None, [lang or ""], bits, None, turn % first[-1]))
                    continue
                for k, name, m in settle(insert(root, text), key, (key, lang or "", bits)):
                    done.append((k, [name], m | duplicate, None, turn % first[-1]))
                size += len(text) + _ROW
            yield from batches_of(done)
            if size >= CHUNK_BYTES:
                yield from close(root)
                root, size = Node(b""), 0
        yield from close(root)

    def close(root: Node) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for text, node in ends(root):
            held.append((node.least, [r[1] for r in node.rows], node.rows[0][2], text, slot(text)))
            size += len(text)
            if size >= 4 << 20:
                yield from batches_of(held)
                held, size = [], 0
        yield from batches_of(held)

    return combine


def _resolve(kind: pa.DataType):
    """Rows of whole ranges to (doc_id, lang, mask); rows without a text are settled already."""
    schema = pa.schema([("doc_id", kind), ("lang", pa.string()), ("mask", pa.int32())])
    duplicate = 1 << FILTERS.index("E")

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root, now = Node(b""), None
        for batch in batches:
            out = []
            for key, langs, bits, text, slot in zip(*(c.to_pylist() for c in batch.columns)):
                if slot != now:
                    out += [(node.least, lang, m) for _, node in ends(root) for names, m in node.rows for lang in names]
                    root, now = Node(b""), slot
                if text is None:
                    out += [(key, lang, bits) for lang in langs]
                    continue
                node = insert(root, text)
                if node.rows is not None and key < node.least:
                    out += [(node.least, lang, m | duplicate) for names, m in node.rows for lang in names]
                    node.rows = None
                out += [(key, lang, m | duplicate) for names, m in settle(node, key, (langs, bits)) for lang in names]
            yield batch_of(out)
        out = [(node.least, lang, m) for _, node in ends(root) for names, m in node.rows for lang in names]
        for i in range(0, len(out), 10_000):
            yield batch_of(out[i : i + 10_000])

    return resolve


def masks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """A row per document: doc_id, lang, mask (a bit for each filter it fails, A the lowest).

    Null texts and languages are empty. A row fails E if a smaller doc_id has the same text; rows of one doc_id and text
    are copies of neither, and a null doc_id is neither smaller nor larger than any. Copies are settled where they
    lie first, so each chunk of a task sends one row of a text at most. Other columns are not looked at; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    kind, arrow = rows.schema["doc_id"].dataType.simpleString(), pa.schema([("x", _arrow(rows))]).field(0).type
    total = rows.agg(F.coalesce(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + _ROW), F.lit(0)).alias("b")).first()["b"]
    wanted = max(partitions(spark), math.ceil(total / RANGE_BYTES))
    ranges = min(RANGES, wanted)
    found = rows.select("text").mapInArrow(_sample(max(1.0, total / (ranges * OVERSAMPLE))), "prefix binary").collect()
    bounds, first = slots([bytes(r["prefix"]) for r in found], ranges, wanted)
    tasks = min(first[-1], RANGES)
    dealt = rows.mapInArrow(_combine(bounds, first, arrow), _KEPT.format(kind=kind))
    dealt = dealt.repartitionById(tasks, F.floor(F.col("slot").cast("long") * tasks / first[-1]).cast("int"))
    return (dealt.sortWithinPartitions("slot") if first[-1] > tasks else dealt).mapInArrow(_resolve(arrow), f"doc_id {kind}, lang string, mask int")


def _arrow(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["doc_id"].dataType)


def _orders() -> Column:
    """All orders of the filters, step by step: the order, the step, its filter's bit, and the bits of those before it."""
    steps = []
    for order in itertools.permutations(FILTERS):
        bits = [1 << FILTERS.index(f) for f in order]
        steps += [f"named_struct('filter_order','{''.join(order)}','step',{i + 1},'own',{bits[i]},'before',{sum(bits[:i])})" for i in range(len(bits))]
    return F.expr(f"array({','.join(steps)})")


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Counts of all orders of the filters, step by step, for each language: part, filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost, shapley.

    A document is good or toxic if any of its rows in labels says so; documents without a label, and labels without a
    document, count as neither. Every part has all 600 rows, zeros included; an empty table has no parts.
    """
    said = labels.filter(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    rows = masks(docs, doc_id, text, lang).groupBy("doc_id", "lang", "mask").agg(F.count(F.lit(1)).alias("n")).join(said, "doc_id", "left")
    count = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    counted = written(rows.groupBy(F.col("lang").alias("part"), "mask").agg(F.sum("n").alias("n"), count(F.col("good") == 1).alias("good"), count(F.col("toxic") == 1).alias("toxic")), "masks")
    steps = counted.select("*", F.explode(_orders()).alias("s")).select("part", "mask", "n", "good", "toxic", "s.*")
    m, own, before = F.col("mask"), F.col("own"), F.col("before")
    fails, gone = m.bitwiseAND(own) != 0, m.bitwiseAND(before) != 0
    total = lambda c, what: F.coalesce(F.sum(F.when(c, F.col(what))), F.lit(0)).cast("long")
    # of the orders, a filter removes a document in its share of the filters which that document fails
    share = F.expr(f"{math.factorial(len(FILTERS))} div greatest(bit_count(mask), 1)")
    return steps.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone, "n").alias("kept"),
        total(fails & ~gone, "n").alias("removed"),
        total(fails & gone, "n").alias("redundant"),
        total(m == own, "n").alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"),
        F.coalesce(F.sum(F.when(fails, F.col("n") * share)), F.lit(0)).cast("long").alias("shapley"),
    )
