"""Pseudo-likelihood of documents under a bidirectional window network, trained in numpy, and counts of words.

The network predicts the symbol of each word from the words on both sides of it; the word itself is masked. The most
frequent words have symbols of their own. All others share some symbols by hash, and a word of these has the probability
within its symbol that the counts over the whole corpus give it, in a table that grows with the corpus. Copies are trained on documents dealt by hash
and averaged, weighted by their words, with what the optimiser has gathered; the documents are dealt over a few rounds, so training passes once
over all of them. A document's score is the sum of the log-probabilities of its words:
that of the symbol given both sides, and that of the word given the symbol.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written
from .text import LETTERS, U, Words, chunks

#: CLASSES * CLASSES symbols are predicted as two classes, the second given the first; so many of them are shared by rarer words.
CLASSES, SHARED = 96, 1024
#: Words with symbols of their own, at most, and how often such a word occurs at least.
COMMON, COMMON_COUNT = CLASSES * CLASSES - SHARED, 8
#: Words on each side, size of the hidden layer, rounds, words in a step, learning rate, sum of squares that it begins with.
SIDE, HIDDEN, ROUNDS, STEP, RATE, SQUARE = 2, 24, 4, 8192, 0.15, 1e-4
#: Bytes of text that a copy is trained on in a round, and tasks that train copies at most.
COPY_BYTES, TASKS = 32 << 20, 20_000
#: Words that are counted or scored together, about; each distinct one of them is joined once.
BLOCK = 1_500_000
#: Rows that an average takes at once, and parts that the parameters travel in.
FAN_IN, PARTS = 256, 16
_OFFSETS = [o for o in range(-SIDE, SIDE + 1) if o]
_NONE = CLASSES * CLASSES  # beyond a document's ends
_SHAPES = {"embed": (len(_OFFSETS), _NONE + 1, HIDDEN), "bias": (HIDDEN,), "w1": (HIDDEN, CLASSES), "b1": (CLASSES,), "w2": (CLASSES, HIDDEN, CLASSES), "b2": (CLASSES, CLASSES)}
_SQUARES = _SHAPES | {"embed": (len(_OFFSETS), _NONE + 1, 1)}  # one for a whole vector
_SIZE = sum(int(np.prod(s)) for s in _SHAPES.values())


class Model(NamedTuple):
    """Parameters, and the sorted hashes of the words that have symbols of their own."""

    flat: np.ndarray
    common: np.ndarray


def initial(seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return np.concatenate([(rng.standard_normal(s) * (0.1 if name in ("embed", "w1", "w2") else 0)).ravel() for name, s in _SHAPES.items()]).astype(np.float32)


def squares_at_first() -> np.ndarray:
    return np.full(sum(int(np.prod(s)) for s in _SQUARES.values()), SQUARE, np.float32)


def unpack(flat: np.ndarray, shapes: dict[str, tuple[int, ...]] = _SHAPES) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in shapes.items():
        size = int(np.prod(shape))
        out[name] = flat[at : at + size].reshape(shape)
        at += size
    return out


def symbols(data: np.ndarray, at: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the words of a chunk: symbols, symbols around each (one column per offset), rows."""
    return _symbols(Words(data, at, LETTERS), common)


def _symbols(w: Words, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = COMMON + (w.hashes >> U(52)).astype(np.int64) % SHARED
    if len(common):
        place = np.minimum(np.searchsorted(common, w.hashes), len(common) - 1)
        ids = np.where(common[place] == w.hashes, place, ids)
    around = np.full((len(_OFFSETS), len(ids)), _NONE, dtype=np.int64)
    for column, o in zip(around, _OFFSETS):
        if len(ids) > abs(o):
            here, there = (slice(max(0, x), len(ids) - max(0, -x)) for x in (-o, o))
            np.copyto(column[here], ids[there], where=w.row[here] == w.row[there])
    around = around.T
    return ids, around, w.row


def _exp(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials, in place of the logits, and their sums by row; beyond 60, which float32 could not hold, logits are cut."""
    np.clip(logits, -60, 60, out=logits)
    np.exp(logits, out=logits)
    return logits, logits @ np.ones(CLASSES, logits.dtype)


def _by_class(ids: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order of words by first class, and each class that occurs with its place in this order."""
    first = (ids // CLASSES).astype(np.int16)
    order = np.argsort(first, kind="stable")  # by radix
    edges = np.searchsorted(first[order], np.arange(CLASSES + 1))
    return order, [(int(c), slice(edges[c], edges[c + 1])) for c in np.flatnonzero(np.diff(edges))]


def _weights(p: dict) -> tuple[np.ndarray, np.ndarray]:
    """Of the first and of the second classes: weights, with the bias as that of one more hidden unit, which is 1."""
    return np.concatenate([p["w1"], p["b1"][None]]), np.concatenate([p["w2"], p["b2"][:, None]], axis=1)


def _logits(p: dict, weights: tuple[np.ndarray, np.ndarray], runs: list[tuple[int, slice]], around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words in order of their first class: hidden layer, with the unit that is 1, and logits of the first and of the second classes, given the first."""
    total = np.take(p["embed"][0], around[:, 0], axis=0)
    for c in range(1, around.shape[1]):
        total += np.take(p["embed"][c], around[:, c], axis=0)
    total += p["bias"]
    hidden = np.ones((len(around), HIDDEN + 1), np.float32)
    np.tanh(total, out=hidden[:, :HIDDEN])
    first = hidden @ weights[0]
    second = np.empty_like(first)
    for c, run in runs:
        np.matmul(hidden[run], weights[1][c], out=second[run])
    return hidden, first, second


def _ordered(around: np.ndarray, order: np.ndarray) -> np.ndarray:
    return np.take(around.T, order, axis=1).T  # each offset lies in one piece


def log_probabilities(p: dict, ids: np.ndarray, around: np.ndarray, weights: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Of the symbols, given those around them."""
    order, runs = _by_class(ids)
    ids, row, out = ids[order], np.arange(len(ids)), np.empty(len(ids), np.float32)
    _, first, second = _logits(p, weights or _weights(p), runs, _ordered(around, order))
    own = first[row, ids // CLASSES], second[row, ids % CLASSES]
    out[order] = sum(np.clip(x, -60, 60) - np.log(_exp(logits)[1]) for x, logits in zip(own, (first, second)))
    return out


def learn(p: dict, squares: dict, ids: np.ndarray, around: np.ndarray) -> None:
    """One step of Adagrad on the mean log-loss, times the square root of the words, of a run of words.

    The vector of a word on a side has one sum of squares, of means over the vector.
    """
    order, runs = _by_class(ids)
    ids, around, n, row = ids[order], _ordered(around, order), len(ids), np.arange(len(ids))
    hidden, first, second = _logits(p, weights := _weights(p), runs, around)
    scale = np.float32(1 / np.sqrt(n))
    for logits, own in ((first, ids // CLASSES), (second, ids % CLASSES)):
        _, total = _exp(logits)
        logits *= (scale / total)[:, None]
        logits[row, own] -= scale
    back, more = first @ p["w1"].T, np.empty((n, HIDDEN), np.float32)
    g1, g2 = hidden.T @ first, np.zeros_like(weights[1])  # of the classes that don't occur, nothing changes
    for c, run in runs:
        np.matmul(second[run], p["w2"][c].T, out=more[run])
        np.matmul(hidden[run].T, second[run], out=g2[c])
    back += more
    back *= 1 - hidden[:, :HIDDEN] ** 2

    for name, g in (("bias", np.ones(n, np.float32) @ back), ("w1", g1[:HIDDEN]), ("b1", g1[HIDDEN]), ("w2", g2[:, :HIDDEN]), ("b2", g2[:, HIDDEN])):
        squares[name] += g * g
        p[name] -= RATE * g / np.sqrt(squares[name])
    back64, unit = back.astype(np.float64).ravel(), np.arange(HIDDEN)
    for vectors, square, near in zip(p["embed"], squares["embed"], around.T):
        there = np.bincount(near, minlength=_NONE + 1) > 0
        at, place = np.flatnonzero(there), np.take(np.cumsum(there) - 1, near) * HIDDEN
        g = np.bincount((place[:, None] + unit).ravel(), weights=back64).astype(np.float32).reshape(-1, HIDDEN)
        sums = np.take(square, at, axis=0) + (np.einsum("ij,ij->i", g, g) / HIDDEN)[:, None]
        square[at] = sums
        vectors[at] = np.take(vectors, at, axis=0) - g * (RATE / np.sqrt(sums))


_COPY = "part int, source long, words double, weights binary"


def _copies(state: np.ndarray, source: int, words: int) -> pa.RecordBatch:
    pieces = np.array_split(state.astype("<f4"), PARTS)
    return pa.RecordBatch.from_arrays(
        [pa.array(range(PARTS), pa.int32()), pa.array([source] * PARTS, pa.int64()), pa.array([float(words)] * PARTS), pa.array([x.tobytes() for x in pieces], pa.binary())], names=["part", "source", "words", "weights"]
    )


def _train(start, common):
    """(copy, text), sorted by copy, to the trained copies."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, words, state = None, 0, None
        for batch in batches:
            copies = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.diff(copies, prepend=-1, append=-1)).tolist()
            for i, j in zip(edges, edges[1:]):
                if copies[i] != source:
                    if words:
                        yield _copies(state, source, words)
                    source, words, state = int(copies[i]), 0, start.value.copy()
                    p, squares = unpack(state), unpack(state[_SIZE:], _SQUARES)
                for _, _, data, at in chunks(batch.column(1).slice(i, j - i)):
                    ids, around, _ = symbols(data, at, common.value)
                    for a in range(0, len(ids), STEP):
                        learn(p, squares, ids[a : a + STEP], around[a : a + STEP])
                    words += len(ids)
        if words:
            yield _copies(state, source, words)

    return train


def _average(table: pa.Table) -> pa.Table:
    total, words = 0, 0.0
    for n, weights in zip(table.column("words").to_pylist(), table.column("weights").to_pylist()):
        total = total + n * np.frombuffer(weights, "<f4").astype(np.float64)
        words += n
    return pa.table({"part": table.column("part").slice(0, 1), "source": pa.array([table.column("source")[0].as_py() // FAN_IN], pa.int64()), "words": pa.array([words]), "weights": pa.array([(total / words).astype("<f4").tobytes()], pa.binary())})


def _symbol(common: DataFrame, counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of words without symbols of their own: h, n, symbol (shared), and each such symbol with the sum of n (SHARED rows at most)."""
    rare = counted.join(F.broadcast(common), "h", "left_anti").withColumn("symbol", COMMON + F.shiftrightunsigned("h", 52) % SHARED)
    return rare, rare.groupBy("symbol").agg(F.sum("n").alias("total"))


def _hashes(spark, common: np.ndarray) -> DataFrame:
    return spark.createDataFrame(pa.table({"h": pa.array(common.view(np.int64))}))


def untrained(counted: DataFrame) -> Model:
    """The model that knows counts only: symbols have their frequency, whatever is around them.

    `counted` is a table of words(). Of it the COMMON most frequent words come to the driver, of equal ones those of the least hash.
    """
    top = counted.filter(F.col("n") >= COMMON_COUNT).orderBy(F.desc("n"), "h").limit(COMMON).toPandas()
    common = top["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(common)
    common, seen = common[order], np.ones(_NONE)
    seen[: len(common)] += top["n"].to_numpy(np.int64)[order]
    for row in _symbol(_hashes(counted.sparkSession, common), counted)[1].collect():
        seen[row["symbol"]] += row["total"]
    flat, seen = initial(), seen.reshape(CLASSES, CLASSES)
    p = unpack(flat)
    p["b1"][:] = np.log(seen.sum(axis=1) / seen.sum())
    p["b2"][:] = np.log(seen / seen.sum(axis=1, keepdims=True))
    return Model(flat, common)


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", counted: DataFrame | None = None) -> Model:
    """The model after one pass over all texts, in ROUNDS rounds of averaging; each round reads the documents whose hash is its own.

    `counted` is words() of these documents, which is made where it is not given. Documents are dealt to copies by hash, COPY_BYTES to each, and sorted by it,
    so files and partitions don't matter; averages are summed in an order of their own, so they can differ in the last digits.
    A null or empty text teaches nothing; rows with equal doc_id and text are as many texts, of one copy; without any words
    the model is that of no counts. Other columns are not read.
    """
    model = untrained(words(docs, text) if counted is None else counted)
    spark, state = docs.sparkSession, np.concatenate([model.flat, squares_at_first()])
    docs = docs.select(F.xxhash64(F.lit(11), doc_id, text).alias("deal"), F.col(text).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = max(1, round(total / ROUNDS / COPY_BYTES))
    tasks = min(parts, TASKS)
    common = spark.sparkContext.broadcast(model.common)  # these two have fixed sizes
    for r in range(ROUNDS):
        mine = docs.filter(F.pmod("deal", F.lit(ROUNDS)) == r).withColumn("copy", F.pmod(F.shiftright("deal", 8), F.lit(parts)))
        mine = mine.repartitionById(tasks, F.pmod("copy", F.lit(tasks)).cast("int")).sortWithinPartitions("copy", "deal", "text").select("copy", "text")
        start = spark.sparkContext.broadcast(state)
        copies = written(mine.mapInArrow(_train(start, common), _COPY), "copies")
        while True:
            copies = written(copies.groupBy("part", F.floor(F.col("source") / FAN_IN).alias("to")).applyInArrow(_average, _COPY), "average")
            if copies.select("source").distinct().count() <= 1:
                break
        rows = sorted(copies.collect(), key=lambda x: x["part"])  # PARTS rows
        if rows:
            state = np.concatenate([np.frombuffer(x["weights"], "<f4") for x in rows])
    return Model(state[:_SIZE].copy(), model.common)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def flush() -> pa.RecordBatch:
        words, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

    for batch in batches:
        for _, _, data, at in chunks(batch.column(0)):
            held.append(Words(data, at, LETTERS).hashes)
            size += len(held[-1])
            if size >= BLOCK:
                yield flush()
                held, size = [], 0
    if size:
        yield flush()


def words(docs: DataFrame, text: str = "text") -> DataFrame:
    """The distinct words of all texts (h, a 64-bit hash) and how often each occurs (n)."""
    return written(docs.select(text).mapInArrow(_count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "words")


def _score(model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, sums = [np.zeros(0, np.int64)], [np.zeros(0)]
            for _, _, n, total, _, _ in _scored(model.value, batch.column(1)):
                counts.append(n)
                sums.append(total)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(counts).astype(np.int64)), pa.array(np.concatenate(sums).astype(np.float64))], names=["doc_id", "n_words", "log_likelihood"])

    return score


def _scored(model: Model, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of runs of rows: first row, row after the last, words of each, sum of the log-probabilities of their symbols, words of each
    that share symbols, hashes of all of these."""
    p = unpack(model.flat)
    weights = _weights(p)
    for i, j, data, at in chunks(column):
        w = Words(data, at, LETTERS)
        ids, around, row = _symbols(w, model.common)
        log = [log_probabilities(p, ids[a : a + STEP], around[a : a + STEP], weights) for a in range(0, len(ids), STEP)]
        sums = np.bincount(row, weights=np.concatenate(log), minlength=j - i) if log else np.zeros(j - i)
        rare = ids >= COMMON
        yield i, j, np.bincount(row, minlength=j - i), sums, np.bincount(row[rare], minlength=j - i), w.hashes[rare]


def _blocks(model):
    """(doc_id, text) to blocks of documents: their ids, words, sums and words that share symbols, the distinct ones of these, and the place of each among them."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, size = 0, [], 0
        first = TaskContext.get().partitionId() << 31

        def flush() -> pa.RecordBatch:
            distinct, place = np.unique(np.concatenate([x[4] for x in held]), return_inverse=True)
            numbers = [pa.array(np.concatenate([x[c] for x in held]).astype(kind)) for c, kind in ((1, np.int64), (2, np.float64), (3, np.int64))]
            lists = [pa.concat_arrays([x[0] for x in held]), *numbers]
            columns = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
            return pa.RecordBatch.from_arrays(
                [pa.array([first + made], pa.int64()), *columns, pa.array([distinct.tobytes()], pa.binary()), pa.array([place.astype("<u4").tobytes()], pa.binary())],
                names=["block", "doc_ids", "counts", "sums", "rares", "words", "places"],
            )

        for batch in batches:
            for i, j, counts, sums, rares, hashes in _scored(model.value, batch.column(1)):
                held.append((batch.column(0).slice(i, j - i), counts, sums, rares, hashes))
                size += int(counts.sum()) + j - i
                if size >= BLOCK:
                    yield flush()
                    made, held, size = made + 1, [], 0
        if held:
            yield flush()

    return blocks


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, packed in zip(batch.column(0), batch.column(1)):
            h = np.frombuffer(packed.as_py(), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), block.as_py(), np.int64)), pa.array(np.arange(len(h), dtype=np.int32)), pa.array(h)], names=["block", "place", "h"])


def _add(blocks: pa.Table, logs: pa.Table) -> pa.Table:
    log = np.zeros(len(logs))
    log[logs.column("place").to_numpy()] = logs.column("log").to_numpy()
    ids, counts, sums, rares = (blocks.column(c).combine_chunks().flatten() for c in ("doc_ids", "counts", "sums", "rares"))
    places = np.frombuffer(blocks.column("places")[0].as_py(), "<u4")
    row = np.repeat(np.arange(len(ids)), rares.to_numpy())
    total = sums.to_numpy() + np.bincount(row, weights=log[places], minlength=len(ids))
    return pa.table({"doc_id": ids, "n_words": counts, "log_likelihood": pa.array(total)})


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", counted: DataFrame | None = None) -> DataFrame:
    """Per document: doc_id, n_words, log_likelihood (sum of natural logarithms), per_word (its mean; null without words).

    `counted` is a table of words() and gives each word that shares its symbol its probability within it: of the n words of the symbol
    that were counted, and one more, which stands for all words that were not. Without it, a score is of symbols only.
    A null or empty text has no words and the sum 0; null and repeated doc_ids are carried along; an empty table
    gives an empty result; other columns are not read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    common, model = _hashes(docs.sparkSession, model.common), docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.select(doc_id, text)
    schema = f"doc_id {kind}, n_words long, log_likelihood double"
    if counted is None:
        out = docs.mapInArrow(_score(model), schema)
    else:
        made = docs.mapInArrow(_blocks(model), f"block long, doc_ids array<{kind}>, counts array<long>, sums array<double>, rares array<long>, words binary, places binary")
        blocks = written(made, "scored")
        rare, totals = _symbol(common, counted)
        symbol = COMMON + F.shiftrightunsigned("h", 52) % SHARED
        logs = blocks.select("block", "words").mapInArrow(_distinct, "block long, place int, h long").join(rare.drop("symbol"), "h", "left").withColumn("symbol", symbol).join(F.broadcast(totals), "symbol", "left")
        logs = logs.select("block", "place", F.log(F.coalesce("n", F.lit(1)) / (F.coalesce("total", F.lit(0)) + 1)).alias("log"))
        out = blocks.drop("words").groupBy("block").cogroup(logs.groupBy("block")).applyInArrow(_add, schema)
    return out.withColumn("per_word", F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words"))).withColumnRenamed("doc_id", doc_id)
