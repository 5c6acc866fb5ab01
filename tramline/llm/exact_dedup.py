"""Exact deduplication by an exchange of Golomb-coded fingerprints.

Each map partition sends the sorted distinct fingerprints of its rows, Golomb-coded, to the owners of the hash
ranges; the digests themselves stay where they are. Owners send back one bit per fingerprint: does it occur again anywhere? Only rows with a set bit are suspects;
their texts are shuffled and grouped byte by byte, after a partial grouping where they lie.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import packed, partitions, row_hash, sized, unpacked, written

#: Bits of a fingerprint within its owner's range. Chance hits among them only make more suspects.
BITS = 44
#: Up to so many suspect digests (32 bytes each) are broadcast; more of them are joined by a shuffle.
BROADCAST_DIGESTS = 200_000
#: Rows whose fingerprints are coded together, and chunks of rows whose bitmaps are broadcast at most.
CHUNK, BROADCAST_CHUNKS = 20_000, 10_000
#: Fingerprints that an owner compares at once, about: with more rows there are more owners, whatever the settings of shuffles.
OWNER_ROWS = 4_000_000


def golomb_encode(values: np.ndarray, bits: int) -> tuple[int, bytes]:
    """Sorted numbers below 2**bits as Golomb-Rice codes of their gaps: all remainders, then all unary quotients."""
    n = len(values)
    k = max(0, bits - max(1, n).bit_length())
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    low = ((gaps[:, None] >> np.arange(k, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel()
    ends = np.cumsum((gaps >> np.uint64(k)).astype(np.int64) + 1)
    unary = np.zeros(int(ends[-1]) if n else 0, dtype=np.uint8)
    unary[ends - 1] = 1
    return k, np.packbits(np.concatenate([low, unary])).tobytes()


def golomb_decode(n: int, k: int, code: bytes) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(code, dtype=np.uint8))
    low = bits[: n * k].reshape(n, k).astype(np.uint64) << np.arange(k, dtype=np.uint64)
    ends = np.flatnonzero(bits[n * k :])[:n]
    quotients = np.diff(ends, prepend=-1) - 1
    return np.cumsum((quotients.astype(np.uint64) << np.uint64(k)) + low.sum(axis=1, dtype=np.uint64), dtype=np.uint64)


_CODED = "part int, chunk int, first long, doc_ids array<{kind}>, sizes array<long>, shas binary, blocks array<struct<owner:int,n:int,k:int,code:binary,twice:binary>>"
_BLOCKS = pa.list_(pa.struct([("owner", pa.int32()), ("n", pa.int32()), ("k", pa.int32()), ("code", pa.binary()), ("twice", pa.binary())]))


def _fingerprints(shas: bytes, owners: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct fingerprints with their owners above them, sorted; the place of each row's among these, and how many rows have each."""
    words = np.frombuffer(shas, dtype=">u8").reshape(-1, 4)
    every = (words[:, 0] % np.uint64(owners)).astype(np.uint64) << np.uint64(BITS) | words[:, 1].astype(np.uint64) >> np.uint64(64 - BITS)
    return np.unique(every, return_inverse=True, return_counts=True)


def _code(owners: int):
    """(doc_id, text) to chunks of rows: their digests, and coded fingerprints for each owner, with a bit for those of several rows."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, chunk = TaskContext.get().partitionId(), 0, 0
        ids, sizes, shas = [], [], []

        def flush() -> pa.RecordBatch:
            packed_shas = b"".join(shas)
            distinct, _, counts = _fingerprints(packed_shas, owners)
            owner, value = (distinct >> np.uint64(BITS)).astype(np.int64), distinct & np.uint64((1 << BITS) - 1)
            blocks = []
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            for a, b in zip(starts.tolist(), np.append(starts[1:], len(owner)).tolist()):
                k, coded = golomb_encode(value[a:b], BITS)
                blocks.append({"owner": int(owner[a]), "n": b - a, "k": k, "code": coded, "twice": np.packbits(counts[a:b] > 1).tobytes()})
            lists = [pa.concat_arrays(ids), pa.array(sizes, pa.int64())]
            columns = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([chunk], pa.int32()), pa.array([first], pa.int64()), *columns, pa.array([packed_shas], pa.binary()), pa.array([blocks], _BLOCKS)],
                names=["part", "chunk", "first", "doc_ids", "sizes", "shas", "blocks"],
            )

        for batch in batches:
            ids.append(batch.column(0))
            for value in batch.column(1).cast(pa.large_binary()):
                data = value.as_buffer() if value.is_valid else b""
                shas.append(hashlib.sha256(data).digest())
                sizes.append(len(data))
            if len(shas) >= CHUNK:
                yield flush()
                first, chunk = first + len(shas), chunk + 1
                ids, sizes, shas = [], [], []
        if shas:
            yield flush()

    return code


def _answer(table: pa.Table) -> pa.Table:
    """An owner's bit for each fingerprint of each block: does it occur in another block, or twice in this one?"""
    blocks = table.to_pylist()
    _, inverse, counts = np.unique(np.concatenate([golomb_decode(b["n"], b["k"], b["code"]) for b in blocks]), return_inverse=True, return_counts=True)
    again, at, out = counts[inverse] > 1, 0, []
    for b in blocks:
        bits = again[at : at + b["n"]] | np.unpackbits(np.frombuffer(b["twice"], np.uint8))[: b["n"]].astype(bool)
        out.append({"part": b["part"], "chunk": b["chunk"], "owner": b["owner"], "n": b["n"], "bits": np.packbits(bits).tobytes()})
        at += b["n"]
    return pa.Table.from_pylist(out, schema=pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("owner", pa.int32()), ("n", pa.int32()), ("bits", pa.binary())]))


def _mark(owners: int):
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                shas = row.column("shas")[0].as_py()
                n = len(shas) // 32
                _, place, _ = _fingerprints(shas, owners)
                replies = sorted(row.column("replies")[0].as_py(), key=lambda r: r["owner"])
                again = np.concatenate([np.unpackbits(np.frombuffer(r["bits"], np.uint8))[: r["n"]] for r in replies]).astype(bool)
                fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(32), n, [None, pa.py_buffer(shas)]).cast(pa.binary())
                first = row.column("first")[0].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row.column("part")[0].as_py(), np.int32)), pa.array(first + np.arange(n)), row.column("doc_ids").flatten(), row.column("sizes").flatten(), fixed, pa.array(again[place.ravel()])],
                    names=["part", "pos", "doc_id", "n_bytes", "sha", "suspect"],
                )

    return mark


def suspects(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: part, pos (its place), doc_id, n_bytes, sha, suspect (its fingerprint occurs again).

    Digests stay where they were made; codes go to the owners, one for each distinct fingerprint of a chunk, and bitmaps come back.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    owners = max(partitions(docs.sparkSession), math.ceil(docs.count() / OWNER_ROWS))
    rows = written(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(_code(owners), _CODED.format(kind=kind)), "digests")
    blocks = rows.select("part", "chunk", F.explode("blocks").alias("b")).select("part", "chunk", "b.*")
    replies = blocks.groupBy("owner").applyInArrow(_answer, "part int, chunk int, owner int, n int, bits binary")
    replies = written(replies.groupBy("part", "chunk").agg(F.collect_list(F.struct("owner", "n", "bits")).alias("replies")), "replies")
    marked = rows.drop("blocks").join(sized(replies, BROADCAST_CHUNKS), ["part", "chunk"])
    return written(marked.mapInArrow(_mark(owners), f"part int, pos long, doc_id {kind}, n_bytes long, sha binary, suspect boolean"), "suspects")


def _suspect_rows(docs: DataFrame, marked: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """The documents as structs `row`, with _text and _sha: suspects, and all the others."""
    keys = sized(written(marked.filter("suspect").select(F.col("sha").alias("_sha")).distinct(), "suspect-keys"), BROADCAST_DIGESTS)
    hashed = packed(docs).withColumn("_text", F.coalesce(F.col("row")[text], F.lit(""))).withColumn("_sha", F.unhex(F.sha2("_text", 256)))
    return hashed.join(keys, "_sha", "left_semi"), hashed.join(keys, "_sha", "left_anti")


def duplicate_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Finds groups of equal texts: per document doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical byte for byte; a null text counts as empty, and empty texts are equal to each
    other. Of a group the row with the largest doc_id stays (null is less than any); of repeated rows with that
    doc_id, one. An empty table gives an empty result. Other columns are not looked at.
    """
    docs = docs.select(doc_id, text)
    marked = suspects(docs, doc_id, text)
    found, _ = _suspect_rows(docs, marked, text)
    groups = found.groupBy("_sha", "_text").agg(F.max(F.col("row")[doc_id]).alias("keep_id"), F.count(F.lit(1)).alias("group_size")).drop("_text")
    top = marked.filter("suspect").groupBy(F.col("sha").alias("_sha")).agg(F.max(F.struct("doc_id", "part", "pos")).alias("_top"))
    groups = written(groups.join(top, "_sha"), "groups")
    out = marked.join(groups, marked["sha"] == groups["_sha"], "left")
    alone = F.col("_sha").isNull()
    return out.select(
        F.col("doc_id").alias(doc_id),
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | ((F.col("part") == F.col("_top.part")) & (F.col("pos") == F.col("_top.pos")))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without all but one row of each group of equal texts, with the columns as they were.

    The row with the largest doc_id stays (null is less than any); of several with that doc_id, that of the largest hash of the row
    as JSON, so columns of any type can be carried along, maps and variants too.
    """
    found, others = _suspect_rows(docs, suspects(docs, doc_id, text), text)
    best = found.groupBy("_sha", "_text").agg(F.max_by("row", F.struct(F.col("row")[doc_id].alias("id"), row_hash("row").alias("h"))).alias("row"))
    return unpacked(others.select("row").unionAll(best.select("row")), docs.columns)
