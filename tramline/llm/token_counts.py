"""Token counts under a unigram model, by dynamic programming over a trie of distinct pre-tokens.

The tasks insert the distinct pre-tokens of their rows in a trie. The forward score of a node (the best way to write
its prefix as pieces of the vocabulary) is computed once for all pre-tokens that share the prefix, level by level;
the node at a pre-token's end gives its count, and a document's count is the sum over its pre-tokens.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import _BYTE, U, mix, powers

#: Longer pre-tokens are counted one by one, by the same recurrence; pre-tokens of a trie; pre-tokens a task holds.
WIDTH, TRIE, HELD = 48, 50_000, 6_000_000
_COUNT_BITS = 20


class Vocabulary:
    """Pieces with costs. A piece of rank r costs ln(r + 2), by Zipf's law, in steps of 1 / 4096; of equal costs fewer pieces win."""

    def __init__(self, ranks_path: str):
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.costs = {p: (round(4096 * math.log(r + 2)) << _COUNT_BITS) + 1 for p, r in ranks.items()}
        self.wide = {p: ((c >> _COUNT_BITS) << 64) + 1 for p, c in self.costs.items()}
        self.lengths = sorted({len(p) for p in ranks})
        up, down = powers(WIDTH + 1)
        rows = [(self._hash(p), c) for p, c in self.costs.items() if len(p) <= WIDTH]
        rows.sort()
        self.keys = np.array([r[0] for r in rows], dtype=U)
        self.values = np.array([r[1] for r in rows], dtype=np.int64)
        assert len(np.unique(self.keys)) == len(self.keys)

    @staticmethod
    def _hash(piece: bytes) -> int:
        up, _ = powers(WIDTH + 1)
        data = np.frombuffer(piece, np.uint8)
        return int(mix(np.array([(_BYTE[data] * up[: len(data)]).sum(dtype=U) + U(len(data))]))[0])

    def one(self, word: bytes) -> int:
        """Pieces of a pre-token of any length, by itself, by pieces of any length."""
        best = [0] + [-1] * len(word)
        for d in range(1, len(word) + 1):
            for n in self.lengths:
                if n > d:
                    break
                cost = self.wide.get(word[d - n : d])
                if cost is not None and best[d - n] >= 0 and (best[d] < 0 or best[d - n] + cost < best[d]):
                    best[d] = best[d - n] + cost
        return best[-1] & ((1 << 64) - 1)

    def trie(self, words: list[bytes]) -> np.ndarray:
        """Pieces of each of sorted, distinct pre-tokens of 1 to WIDTH bytes."""
        n = len(words)
        size = np.array([len(w) for w in words])
        width = int(size.max())
        text = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        up, down = powers(WIDTH + 1)
        sums = np.zeros((n, width + 1), dtype=U)
        np.cumsum(_BYTE[text] * up[:width], axis=1, out=sums[:, 1:])
        shared = np.zeros(n, dtype=np.int64)  # bytes that a word has in common with the one before
        if n > 1:
            differ = np.pad(text[1:] != text[:-1], ((0, 0), (0, 1)), constant_values=True)
            shared[1:] = np.minimum(differ.argmax(axis=1), np.minimum(size[1:], size[:-1]))
        huge = np.int64(1) << 60
        best = np.full((n, width + 1), huge, dtype=np.int64)
        best[:, 0] = 0
        for d in range(1, width + 1):
            alive = np.flatnonzero(size >= d)
            node = alive[shared[alive] < d]  # the first word of each node of this depth
            score = np.full(len(node), huge, dtype=np.int64)
            for k in range(1, d + 1):
                h = mix((sums[node, d] - sums[node, d - k]) * down[d - k] + U(k))
                at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
                known = self.keys[at] == h
                np.minimum(score, np.where(known, best[node, d - k] + self.values[at], huge), out=score)
            best[alive, d] = score[np.searchsorted(node, alive, side="right") - 1]
        return best[np.arange(n), size] & ((1 << _COUNT_BITS) - 1)

    def counts(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros(len(words), dtype=np.int64)
        short = sorted((w, i) for i, w in enumerate(words) if len(w) <= WIDTH)
        for a in range(0, len(short), TRIE):
            part = short[a : a + TRIE]
            out[[i for _, i in part]] = self.trie([w for w, _ in part])
        for i, w in enumerate(words):
            if len(w) > WIDTH:
                out[i] = self.one(w)
        return out


def _count(ranks_path: str, pattern: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        vocabulary, find = Vocabulary(ranks_path), regex.compile(pattern).findall
        known: dict[str, int] = {}
        held: list[tuple[pa.Array, list[np.ndarray]]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            counts = vocabulary.counts([w.encode() for w in known])
            for ids, docs in held:
                totals = [int(counts[d].sum()) for d in docs]
                yield pa.RecordBatch.from_arrays([ids, pa.array([len(d) for d in docs], pa.int64()), pa.array(totals, pa.int64())], names=["doc_id", "n_pretokens", "n_tokens"])

        for batch in batches:
            docs = []
            for text in batch.column(1):
                docs.append(np.array([known.setdefault(w, len(known)) for w in find(text.as_py() or "")], dtype=np.int32))
                size += len(docs[-1])
            held.append((batch.column(0), docs))
            if size >= HELD:
                yield from flush()
                known, held, size = {}, [], 0
        if held:
            yield from flush()

    return count


def token_counts(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_pretokens, n_tokens (pieces of the cheapest segmentation of its pre-tokens).

    The vocabulary is a public one, with every byte a piece, so every text can be written; no piece is too long to be used. Nothing is shuffled: what
    tasks share is the vocabulary. A null or empty text has no tokens; null and repeated doc_ids are carried along;
    an empty table gives an empty result; other columns are not read.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    counted = docs.select(doc_id, text).mapInArrow(_count(ranks_path, pattern), f"doc_id {kind}, n_pretokens long, n_tokens long")
    return counted.withColumnRenamed("doc_id", doc_id)
