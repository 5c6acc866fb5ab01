"""Removal of repeated passages by sliding runs of sentences.

A run begins at every sentence and takes the fewest sentences that are several and have enough words. Runs are
hashed and joined over all documents; of equal runs the first stays, and sentences covered by any other are removed.
Long sentences can be cut by their content, so that a passage is cut alike wherever it stands in them; then the
fewest sentences before every sentence's end make a run, too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import sized, written
from .text import SPACED, U, Words, chunks, mix, powers

#: Sentences and words that a run has at least; words after which a sentence is cut.
SENTENCES, WORDS, LONGEST = 3, 25, 12
#: Up to so many documents to change have their spans broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 400_000
_END = np.isin(np.arange(256), [ord(c) for c in ".!?"])


def _content_cuts(hashes: np.ndarray, begin: np.ndarray, longest: int) -> np.ndarray:
    """Words to cut after: of any `longest` words in a row of a longer sentence, that of the least hash (the last of equal ones).

    Two of them are `longest` words apart at most, and which they are depends on the words around them only.
    """
    if len(hashes) <= longest:
        return np.zeros(0, np.int64)
    of = np.cumsum(begin) - 1
    size = np.bincount(of)[of]
    whole = np.flatnonzero((of[longest - 1 :] == of[: len(of) - longest + 1]) & (size[longest - 1 :] > longest))
    windows = np.lib.stride_tricks.sliding_window_view(hashes, longest)[whole]
    return np.unique(whole + longest - 1 - windows[:, ::-1].argmin(axis=1))


class Sentences:
    """Of a chunk: `start` and `end` (bytes, an end being the next start), `row`, and the runs `hashes`, `first`, `last`."""

    def __init__(self, data: np.ndarray, at: np.ndarray, sentences: int, words: int, longest: int, by_content: bool = False):
        w = Words(data, at, SPACED)
        n = len(w.first)
        if not n:
            self.start = self.end = self.row = self.first = self.last = np.zeros(0, np.int64)
            self.hashes = np.zeros(0, U)
            return
        lines = np.append(0, np.cumsum(data == 10))
        stop = _END[data[w.last - 1]]
        stop[:-1] |= (lines[w.first[1:]] > lines[w.last[:-1]]) | (w.row[1:] != w.row[:-1])
        stop[-1] = True
        begin = np.append(True, stop[:-1])
        if by_content:
            after = _content_cuts(w.hashes, begin, longest) + 1
            begin[after[after < n]] = True
        else:
            index = np.arange(n)
            inside = index - np.maximum.accumulate(np.where(begin, index, 0))
            begin |= inside % longest == 0
        lead = np.flatnonzero(begin)  # first words of sentences
        self.row = w.row[lead]
        follow = np.append(w.first[lead[1:]], len(data))
        self.start, self.end = w.first[lead], np.minimum(follow, at[1:][self.row])
        edge = np.append(lead, n)
        last = np.maximum(np.arange(len(lead)) + sentences - 1, np.searchsorted(edge, lead + words) - 1)
        ok = np.flatnonzero(last < len(lead))
        ok = ok[self.row[last[ok]] == self.row[ok]]
        self.first, self.last = ok, last[ok]
        if by_content:  # the shortest runs that end at a sentence, if they are not the shortest from their start
            stand = np.arange(len(lead))
            start = np.minimum(stand - sentences + 1, np.searchsorted(edge, edge[1:] - words, side="right") - 1)
            new = np.flatnonzero(start >= 0)
            new = new[(self.row[start[new]] == self.row[new]) & (last[start[new]] != new)]
            self.first, self.last = np.append(self.first, start[new]), np.append(self.last, new)
            order = np.argsort(self.first, kind="stable")
            self.first, self.last = self.first[order], self.last[order]
        up, down = powers(n + 1)
        sums = np.append(np.zeros(1, U), np.cumsum(w.hashes * up[:n], dtype=U))
        a, b = lead[self.first], edge[self.last + 1]
        self.hashes = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(U))


def _runs(size: tuple[int, int, int, bool]):
    """(doc_id, sid, text) to runs: h, doc_id, sid, first, last."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, at in chunks(batch.column(2)):
                s = Sentences(data, at, *size)
                row = s.row[s.first] if len(s.first) else s.first
                before = np.searchsorted(s.row, row)
                take = pa.array(i + row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.hashes.view(np.int64)), batch.column(0).take(take), batch.column(1).take(take), pa.array((s.first - before).astype(np.int32)), pa.array((s.last - before).astype(np.int32))],
                    names=["h", "doc_id", "sid", "first", "last"],
                )

    return runs


def _pack(table: pa.Table) -> pa.Table:
    rows = np.stack([table.column("first").to_numpy(), table.column("last").to_numpy()], axis=1).astype("<i4")
    return pa.table({"d": table.column("doc_id").slice(0, 1), "s": table.column("sid").slice(0, 1), "spans": pa.array([rows.tobytes()], pa.binary())})


def _cut(size: tuple[int, int, int, bool]):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, texts, counts, removed = batch.column(2).to_pylist(), [], [], []
            for i, j, data, at in chunks(batch.column(1)):
                s = Sentences(data, at, *size)
                cuts = np.searchsorted(s.row, np.arange(j - i + 1))
                for r in range(j - i):
                    a, b = int(cuts[r]), int(cuts[r + 1])
                    gone = np.zeros(b - a + 1, dtype=np.int64)
                    if spans[i + r] is not None:
                        pairs = np.frombuffer(spans[i + r], "<i4").reshape(-1, 2)
                        np.add.at(gone, pairs[:, 0], 1)
                        np.add.at(gone, pairs[:, 1] + 1, -1)
                    out = np.cumsum(gone)[:-1] > 0
                    counts.append(b - a)
                    removed.append(int(out.sum()))
                    whole = data[at[r] : at[r + 1]]
                    if out.any():
                        keep = np.ones(len(whole), dtype=bool)
                        for x, y in zip(s.start[a:b][out] - at[r], s.end[a:b][out] - at[r]):
                            keep[x:y] = False
                        whole = whole[keep]
                    texts.append(whole.tobytes())
            text = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), text], names=["doc_id", "n_sentences", "n_removed", "text"])

    return cut


def remove_spans(docs: DataFrame, sentences: int = SENTENCES, words: int = WORDS, longest: int = LONGEST, doc_id: str = "doc_id", text: str = "text", by_content: bool = False) -> DataFrame:
    """Returns doc_id, n_sentences, n_removed and text, without the sentences that a non-first repeated run covers.

    A sentence ends with a word that ends in . ! or ?, at a line break, or after `longest` words. With `by_content`, one
    of more words is cut where its words say so instead, and also the shortest runs that end at each sentence are
    joined: of a passage that is repeated anywhere, less than 2 * `longest` words at its ends can be missed, if
    at least `words` words and `sentences` sentences (`words` > (`sentences` - 1) * `longest` sees to these) remain. A
    run has at least `sentences` sentences and `words` words; words are compared by 64-bit hashes, A-Z as a-z, whatever white space is between. The
    first of equal runs is that with the least doc_id (null before all), and there the first place. A null or empty
    text has no sentences and comes back empty; rows with equal doc_id and text are the same document; an empty table
    gives an empty result; other columns are not read.
    """
    size = (sentences, words, longest, by_content)
    kind = docs.schema[doc_id].dataType.simpleString()
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("sid"), F.col(text).alias("text"))
    runs = docs.mapInArrow(_runs(size), f"h long, doc_id {kind}, sid long, first int, last int")
    own = F.struct("doc_id", "sid", "first")
    again = runs.groupBy("h").agg(F.min(own).alias("origin"), F.max(own).alias("other")).filter(~F.col("origin").eqNullSafe(F.col("other"))).select("h", "origin")
    again = written(again, "repeated-runs")
    later = runs.join(again, "h").filter(~own.eqNullSafe(F.col("origin"))).select("doc_id", "sid", "first", "last").distinct()
    spans = written(later.groupBy("doc_id", "sid").applyInArrow(_pack, f"d {kind}, s long, spans binary"), "spans")
    out = docs.join(sized(spans, BROADCAST_ROWS), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("sid") == F.col("s")), "left").select("doc_id", "text", "spans")
    return out.mapInArrow(_cut(size), f"doc_id {kind}, n_sentences long, n_removed long, text string").withColumnRenamed("doc_id", doc_id)
