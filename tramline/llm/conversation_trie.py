"""The prefix trie of conversations, by a skeleton of splitters.

Paths are sorted into shards by range. A node whose members may lie in several shards is a prefix of a splitter; these
nodes, the skeleton, are known before the shards are made and are broadcast as a trie. A shard walks its sorted paths
with one open node per depth and finishes every other node by itself; of skeleton nodes it gives partial sums, which
are added up and then folded from the leaves of the skeleton to its root.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import partitions, written

#: Bytes of paths in a shard, on average, and shards at most.
SHARD_BYTES, SHARDS = 16 << 20, 20_000
#: Sampled paths per shard, bytes of the sample at most, and turns of a sampled path at most.
OVERSAMPLE, SAMPLE_BYTES, SAMPLE_TURNS = 8, 32 << 20, 1_024
#: Bytes of a turn in a path.
TURN = 16
#: Bytes of decimal ids that leave a shard as one row.
CHUNK = 1 << 16
_LEAST = -(1 << 63)
_WORD = r"[^\x20\x09-\x0D]+"


def rebuilt(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = 20, spread: int = 4) -> DataFrame:
    """Rebuilds conversations: conv_id, path (binary, 16 bytes a turn), words (of each turn's text).

    A conversation c gets the first h original turns of conversation c - c % block in place of its own first h, where
    h is the unsigned crc32 of the decimal c modulo spread. Turns are ordered by `turn`, null first, ties by the digest
    of role and text; null role or text is empty. Rows without a conv_id belong to no conversation. A turn is known by
    the MD5 of its role and text, so texts do not travel; a conversation of n turns takes 20 n bytes in a task.
    """
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    who = F.coalesce(F.col(role).cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said).cast("binary"))
    rows = turns.filter(F.col(conv_id).isNotNull()).select(F.col(conv_id).cast("long").alias("conv_id"), F.struct(F.col(turn).alias("turn"), digest.alias("digest"), F.regexp_count(said, F.lit(_WORD)).alias("words")).alias("t"))
    own = written(rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("own")), "conversations")
    heads = own.filter(F.col("conv_id") % block == 0).select(F.col("conv_id").alias("_donor"), F.slice("own", 1, spread - 1).alias("head"))
    both = own.join(heads, F.col("conv_id") - F.col("conv_id") % block == F.col("_donor"), "left")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % spread).cast("int")
    head = F.coalesce("head", F.array().cast(heads.schema["head"].dataType))
    path = F.concat(F.slice(head, F.lit(1), h), F.slice("own", h + 1, F.size("own")))
    return both.select("conv_id", path.alias("p")).select("conv_id", F.unhex(F.array_join(F.col("p.digest"), "")).alias("path"), F.col("p.words").alias("words"))


def splitters(sample: list[tuple[bytes, int]], shards: int) -> list[tuple[bytes, int]]:
    """Bounds (path, conv_id) of at most so many ranges, each path as short as tells it from the one before it in the sample."""
    sample, out = sorted(sample), []
    for k in range(1, shards):
        i = k * len(sample) // shards
        if i < 1:
            continue
        (before, _), (path, conv) = sample[i - 1], sample[i]
        bound = (path, conv) if before == path else (path[: (shared_turns(before, path) + 1) * TURN], _LEAST)
        if not out or bound > out[-1]:
            out.append(bound)
    return out


def shared_turns(a: bytes, b: bytes) -> int:
    """How many whole turns two paths share at their starts."""
    most = min(len(a), len(b)) // TURN
    if a[: most * TURN] == b[: most * TURN]:
        return most
    low, high = 0, most - 1
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[: mid * TURN] == b[: mid * TURN] else (low, mid - 1)
    return low


def skeleton(bounds: list[tuple[bytes, int]]) -> dict[tuple[int, bytes], int]:
    """The trie of the bounds' paths: (node, turn) to child. Node 0 is the root; children have larger numbers."""
    trie: dict[tuple[int, bytes], int] = {}
    for path, _ in bounds:
        at = 0
        for i in range(0, len(path), TURN):
            at = trie.setdefault((at, path[i : i + TURN]), len(trie) + 1)
    return trie


def _place(bounds: list[tuple[bytes, int]]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, ids = batch.column("path").to_pylist(), batch.column("conv_id").to_pylist()
            shard = [bisect_right(bounds, key) for key in zip(paths, ids)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int32())], names=[*batch.schema.names, "shard"])

    return place


_ROW = pa.schema([(n, pa.int64()) for n in ("node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "words")] + [("ends", pa.string()), ("at", pa.int64()), ("chunk", pa.string())])
_ROW_SQL = "node long, parent long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, words long, ends string, at long, chunk string"


class _Node:
    """An open node: what is known of its subtree. `of` is its number in the skeleton, or -1; `rows` are finished children that wait for its least member."""

    __slots__ = ("of", "depth", "words", "least", "convs", "children", "leaves", "saved", "ends", "sha", "held", "size", "first", "rows")

    def __init__(self, of: int, depth: int, words: int):
        self.of, self.depth, self.words = of, depth, words
        self.least, self.convs, self.children, self.leaves, self.saved, self.ends = None, 0, 0, 0, 0, 0
        self.sha, self.held, self.size, self.first, self.rows = (hashlib.sha256() if of < 0 else None), [], 0, None, []

    def end(self, conv: int, out: list) -> None:
        """A member ends here; members come in ascending order."""
        self.convs += 1
        self.least = conv if self.least is None or conv < self.least else self.least
        text = str(conv)
        if self.sha:
            self.sha.update((f",{text}" if self.ends else text).encode())
        else:
            self.first = conv if not self.held else self.first
            self.held.append(text)
            self.size += len(text) + 1
            if self.size >= CHUNK:
                self.flush(out)
        self.ends += 1

    def flush(self, out: list) -> None:
        if self.held:
            out.append((self.of, None, None, None, None, None, None, None, None, None, None, self.first, ",".join(self.held)))
            self.held, self.size = [], 0


def _close(node: _Node, parent: _Node | None, out: list) -> None:
    """Finishes a node: rows of its children leave, and its sums go to its parent, or, for a skeleton node, out as partial sums."""
    if node.of >= 0:
        node.flush(out)
        out.append((node.of, None, node.least, node.depth, None, node.convs, node.children, node.leaves, node.saved, node.words, None, None, None))
        return
    leaves = node.leaves or 1
    saved = node.saved + (node.convs - 1) * node.words
    out.extend((*r[:4], node.least, *r[5:]) for r in node.rows)
    row = (None, parent.of if parent.of >= 0 else None, node.least, node.depth, None, node.convs, node.children, leaves, saved, None, node.sha.hexdigest(), None, None)
    (out if parent.of >= 0 else parent.rows).append(row)
    parent.convs, parent.children, parent.leaves, parent.saved = parent.convs + node.convs, parent.children + 1, parent.leaves + leaves, parent.saved + saved
    parent.least = node.least if parent.least is None or node.least < parent.least else parent.least


def _walk(trie: dict[tuple[int, bytes], int]):
    """Sorted paths to finished nodes, partial sums of skeleton nodes and pieces of their lists of ids."""

    def batch_of(out: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ROW)], schema=_ROW)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack, before, shard, out = [], b"", None, []
        for batch in batches:
            for at, path, conv, words in zip(*(batch.column(c).to_pylist() for c in ("shard", "path", "conv_id", "words"))):
                if at != shard:
                    while stack:
                        node = stack.pop()
                        _close(node, stack[-1] if stack else None, out)
                    stack, before, shard = [_Node(0, 0, 0)], b"", at
                same = shared_turns(before, path)
                while len(stack) - 1 > same:
                    node = stack.pop()
                    _close(node, stack[-1], out)
                for d in range(same, len(path) // TURN):
                    top = stack[-1]
                    stack.append(_Node(trie.get((top.of, path[d * TURN : (d + 1) * TURN]), -1) if top.of >= 0 else -1, d + 1, words[d]))
                stack[-1].end(conv, out)
                before = path
                if len(out) >= 5_000:
                    yield batch_of(out)
                    out = []
        while stack:
            node = stack.pop()
            _close(node, stack[-1] if stack else None, out)
        if out:
            yield batch_of(out)

    return walk


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of lists, sorted by node and place, to a digest per node; a list is never held."""
    now, sha = None, None
    row = lambda: pa.RecordBatch.from_pydict({"node": [now], "ends": [sha.hexdigest()]}, schema=pa.schema([("node", pa.int64()), ("ends", pa.string())]))
    for batch in batches:
        for node, chunk in zip(batch.column("node").to_pylist(), batch.column("chunk").to_pylist()):
            if node != now:
                if sha:
                    yield row()
                now, sha = node, hashlib.sha256(chunk.encode())
            else:
                sha.update(b"," + chunk.encode())
    if sha:
        yield row()


def _fold(trie: dict[tuple[int, bytes], int], sums: dict[int, dict], ends: dict[int, str]) -> list[tuple]:
    """Rows of the skeleton's nodes, each with what its own parts and its skeleton children have; children come before parents."""
    up = {child: parent for (parent, _), child in trie.items()}
    least, children = {}, {}
    for node in sorted(sums, reverse=True):
        s = sums[node]
        s["leaves"] = s["leaves"] or 1
        s["saved"] += (s["convs"] - 1) * s["words"]
        least[node] = s["least"]
        if node in up:
            p = sums[up[node]]
            p["convs"], p["children"], p["leaves"], p["saved"], p["least"] = p["convs"] + s["convs"], p["children"] + 1, p["leaves"] + s["leaves"], p["saved"] + s["saved"], min(p["least"] if p["least"] is not None else s["least"], s["least"])
    empty = hashlib.sha256(b"").hexdigest()
    return [(n, least[n], s["depth"], least[up[n]] if n in up else None, s["convs"], s["children"], s["leaves"], s["saved"], ends.get(n, empty)) for n, s in sums.items()]


def prefix_trie(paths: DataFrame, shard_bytes: int = SHARD_BYTES, shards: int | None = None) -> DataFrame:
    """The nodes of the trie of paths (conv_id, path, words; conv_ids differ), one row each.

    Returns conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. Many conversations of one path are split over shards by conv_id, so none holds them all; the ids that
    end at such a node meet as pieces of text in a stream, as one digest over all of them must. The skeleton has at most
    shards x 1,024 nodes, in practice a few for each shard; only its sums go to the driver. No paths, no nodes.
    """
    spark = paths.sparkSession
    size = F.octet_length("path").cast("long") + 4 * F.size("words") + 32
    cut = F.least(F.octet_length("path"), F.lit(SAMPLE_TURNS * TURN)).cast("long") + 32
    total = paths.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes"), F.coalesce(F.sum(cut), F.lit(0)).alias("cut")).first()
    shards = shards or min(SHARDS, max(partitions(spark), math.ceil(total["bytes"] / shard_bytes)))
    part = min(1.0, OVERSAMPLE * shards / max(1, total["n"]), SAMPLE_BYTES / max(1, total["cut"]))
    chosen = F.pmod(F.xxhash64(F.lit(5), "conv_id"), F.lit(1 << 30)) < int(part * (1 << 30))
    sample = [(bytes(r["path"]), r["conv_id"]) for r in paths.filter(chosen).select(F.substring("path", 1, SAMPLE_TURNS * TURN).alias("path"), "conv_id").collect()] if shards > 1 else []
    bounds = splitters(sample, shards)
    trie = skeleton(bounds)
    dealt = paths.mapInArrow(_place(bounds), "conv_id long, path binary, words array<int>, shard int").repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    rows = written(dealt.mapInArrow(_walk(trie), _ROW_SQL), "trie")
    partial = rows.filter("node is not null and chunk is null").groupBy("node").agg(
        F.min("conv_id").alias("least"), F.min("depth").alias("depth"), F.max("words").alias("words"), *[F.sum(c).alias(n) for c, n in (("n_convs", "convs"), ("n_children", "children"), ("n_leaves", "leaves"), ("saved_tokens", "saved"))]
    )
    lists = rows.filter("chunk is not null").select("node", "at", "chunk").repartition("node").sortWithinPartitions("node", "at").mapInArrow(_digest, "node long, ends string")
    folded = _fold(trie, {r["node"]: r.asDict() for r in partial.collect()}, {r["node"]: r["ends"] for r in lists.collect()})
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    top = spark.createDataFrame(folded, "node long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string")
    parents = F.broadcast(top.select(F.col("node").alias("parent"), F.col("conv_id").alias("_above")))
    rest = rows.filter("node is null").join(parents, "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above"))
    out: list[Column | str] = [*names[:-1], F.col("ends").alias("ends_sha256")]
    return rest.select(*out).unionAll(top.select(*out))
