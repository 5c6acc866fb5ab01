"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

Features of a document are hashes of its words, of the first letters of its words, of pairs of neighbours and of
pairs with one or two words between. Training is online, with a rate per coordinate; its L1 term leaves few weights other than zero,
so the model is a small array that goes with the scoring tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import written
from .text import LETTERS, U, Words, chunks, mix

#: Places of the hashed features; a model has so many weights at most.
PLACES = 1 << 20
#: Bound of the labelled rows that a model is fitted on: those whose hashed id is least.
TRAIN_ROWS = 20_000
#: Bytes at the start of a word that make a feature of their own, if the word is longer.
STEMS = (4, 5, 6)
#: Passes over the training rows, learning rate, its offset, L1 and L2 terms. Chosen among 16 settings by rows that may
#: be learnt from alone: fitted where the remainder is 0 or 3, judged where it is 1. Half or twice the L1 term does about as well.
EPOCHS, ALPHA, BETA, L1, L2 = 5, 0.5, 1.0, 4.0, 0.1


def features(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of features and the rows that have them, kind by kind, for a chunk of texts."""
    w = Words(data, at, LETTERS)
    place = lambda h, salt: (mix(h + U(salt)) >> U(44)).astype(np.int64)
    yield place(w.hashes, 1), w.row
    for n in STEMS:
        long = w.last - w.first > n
        yield place(w.spans(w.first[long], w.first[long] + n), 10 + n), w.row[long]
    for gap in (1, 2, 3):
        a, b = w.hashes[:-gap], w.hashes[gap:]
        same = w.row[:-gap] == w.row[gap:]
        yield place(a[same] + b[same] * U(0x9DDFEA08EB382D69), 100 + gap), w.row[:-gap][same]


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(order, label, text) to (order, label, sorted distinct places as bytes)."""
    for batch in batches:
        out = []
        for i, j, data, at in chunks(batch.column(2)):
            where, rows = map(np.concatenate, zip(*features(data, at)))
            key = np.unique(rows * PLACES + where)
            cut = np.searchsorted(key, np.arange(j - i + 1) * PLACES)
            out += [(key[a:b] % PLACES).astype("<i4").tobytes() for a, b in zip(cut, cut[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["order", "label", "places"])


class Ftrl:
    def __init__(self, places: int):
        self.z, self.n = np.zeros(places + 1), np.zeros(places + 1)  # the last is the constant's

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, l1 = self.z[at], np.where(at == len(self.z) - 1, 0.0, L1)
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: int) -> None:
        at = np.append(at, len(self.z) - 1)
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def _train(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    model = Ftrl(PLACES)
    for frame in frames:
        for label, places in zip(frame["label"], frame["places"]):
            model.learn(np.frombuffer(places, "<i4").astype(np.int64), int(label))
    every = model.weights(np.arange(PLACES + 1))
    at = np.flatnonzero(every)
    yield pd.DataFrame({"place": at, "weight": every[at]})


def fit(docs: DataFrame, labels: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights of all places and, last, the constant.

    Learns from the rows of labels for which `train`, a condition on the label's doc_id, holds; null labels and ids are left out, and
    of several labels of a document the largest counts. TRAIN_ROWS bounds the sample; the trainer reads it as a
    stream in the order of a hash of the ids, so its memory is that of the places, and how rows lie in files changes nothing. A document whose id
    is repeated is learnt from once for each row. Without labelled rows the model says one half.
    """
    picked = labels.filter(train & F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(doc_id).agg(F.max(label).cast("int").alias("label"))
    picked = picked.withColumn("order", F.xxhash64(F.lit(3), doc_id)).orderBy("order", doc_id).limit(rows)
    texts = docs.select(doc_id, text).join(F.broadcast(picked), doc_id).select("order", "label", text)
    sample = written(texts.mapInArrow(_extract, "order long, label int, places binary"), "toxic-train")
    # rows of files come in any order; the trainer's is that of `order`, whatever their layout
    stream = sample.withColumn("epoch", F.explode(F.array(*map(F.lit, range(EPOCHS))))).coalesce(1).sortWithinPartitions("epoch", "order", "label", "places")
    found = stream.select("label", "places").mapInPandas(_train, "place int, weight double").collect()  # PLACES + 1 at most
    weights = np.zeros(PLACES + 1)
    for r in found:
        weights[r["place"]] = r["weight"]
    return weights


def _score(small: np.ndarray, values: np.ndarray, text_at: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(PLACES + 1)
        weights[small] = values
        for batch in batches:
            out = []
            for i, j, data, at in chunks(batch.column(text_at)):
                total, seen = np.full(j - i, weights[-1]), []
                for where, rows in features(data, at):
                    has = np.flatnonzero(weights[where])
                    seen.append(rows[has] * PLACES + where[has])
                key = np.unique(np.concatenate(seen))
                total += np.bincount(key // PLACES, weights=weights[key % PLACES], minlength=j - i)
                out.append(1 / (1 + np.exp(-np.clip(total, -30, 30))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out) if out else [], pa.float64())], names=[*batch.schema.names, "_score"])

    return score


def score(docs: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """The documents with _score, from 0 to 1. A feature counts once in a document. A null or empty text has the constant's score.

    Other columns are carried along; one named _score is replaced. Repeated rows get equal scores; an empty table
    gives an empty result.
    """
    small = np.flatnonzero(weights)
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "_score"])
    names = [f"_{i}" for i in range(len(docs.columns))]
    schema = T.StructType([*(T.StructField(n, f.dataType) for n, f in zip(names, docs.schema)), T.StructField("_score", T.DoubleType())])
    scored = docs.toDF(*names).mapInArrow(_score(small, weights[small], docs.columns.index(text)), schema)
    return scored.toDF(*docs.columns, "_score")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are kept for testing: crc32 of the id as text, modulo 4, is 2; a null id is not one of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
