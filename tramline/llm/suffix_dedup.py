"""Removal of bytes that lie in a long string which occurs again, by suffix arrays.

Every string of `length` bytes is assigned to its anchor: the place of the least hash among its ANCHOR-byte pieces.
Equal strings have equal anchors, so

1. strings of one anchor form a context, and contexts whose anchor piece occurs once are done with;
2. contexts that occur again as a whole are covered as a whole;
3. of contexts that share the anchor piece and differ, cores of STEP strings each go to the owners of their hashes.
   There a core is one symbol and the bytes beside it are symbols, a string is STEP symbols with the core among them,
   and the suffix array of the cores with their flanks shows which strings occur again.

Contexts of an anchor piece that very many contexts share are compared string by string, by hash, instead.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import partitions, sized, written
from .suffix_array import suffix_array
from .text import _BYTE, OTHER_BASE, OTHER_BYTE, U, chunks, mix, powers

#: Bytes of the piece whose hash chooses the anchor, and strings that share a core.
ANCHOR, STEP = 128, 16
#: An anchor piece with more contexts is compared string by string.
HOT_CONTEXTS = 20_000
#: Symbols of a suffix array, unless one core has more.
SYMBOLS = 250_000
#: Owners of hash ranges for each partition of a shuffle; a task takes its owners one after the other.
OWNERS = 4
#: Contexts whose cores go to an owner, about: with more of them there are more owners, whatever the settings of shuffles.
OWNER_CONTEXTS = 50_000
#: Up to so many texts, their places are broadcast, so that texts stay where they are; more are joined by a shuffle.
#: Contexts, of which there are many more, are always joined by a shuffle.
BROADCAST_ROWS = 400_000
_PLACE = U((1 << 32) - 1)  # places in a chunk, which is a text at most or small texts; the hash above them decides first


def _sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=U)
    np.cumsum(_BYTE[data] * up[:-1], out=sums[1:])
    return sums, down


def _other(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As _sums, for a second hash of other constants: what removes bytes has 128 bits."""
    up, down = powers(len(data) + 1, OTHER_BASE)
    sums = np.zeros(len(data) + 1, dtype=U)
    np.cumsum(OTHER_BYTE[data] * up[:-1], out=sums[1:])
    return sums, down


def _hash(sums: np.ndarray, down: np.ndarray, first, last) -> np.ndarray:
    return mix((sums[last] - sums[first]) * down[first] + np.asarray(last - first).astype(U))


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """The least of every w consecutive numbers."""
    n = len(x) - w + 1
    padded = np.append(x, np.full(-len(x) % w, np.iinfo(U).max, dtype=U)).reshape(-1, w)
    left = np.minimum.accumulate(padded, axis=1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1 : w - 1 + n])


def _anchors(length: int):
    """(sid, text) to contexts: sid, anchor, first and last string (starts), hash of the anchor piece, and two of the context."""
    w = length - ANCHOR + 1

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j, data, at in chunks(batch.column(1)):
                if len(data) < length:
                    continue
                sums, down = _sums(data)
                pieces = np.arange(len(data) - ANCHOR + 1)
                h = _hash(sums, down, pieces, pieces + ANCHOR)
                which = (_window_min(h & ~_PLACE | pieces.astype(U), w) & _PLACE).astype(np.int64)
                row = np.repeat(np.arange(j - i), np.diff(at))[: len(which)]
                inside = np.arange(len(which)) + length <= at[1:][row]
                start, which, row = np.flatnonzero(inside), which[inside], row[inside]
                new = np.flatnonzero(np.append(True, (which[1:] != which[:-1]) | (row[1:] != row[:-1]))) if len(start) else start
                first, last = start[new], start[np.append(new[1:], len(start)) - 1] if len(start) else start
                a, r = which[new], row[new]
                place = (a - first).astype(U) * U(0xD6E8FEB86659FD93)
                context = [mix(_hash(*both, first, last + length) + place).view(np.int64) for both in ((sums, down), _other(data))]
                base = at[r]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (sids[i + r], a - base, first - base, last - base, h[a].view(np.int64), *context)],
                    names=["sid", "anchor", "first", "last", "key", "context", "more"],
                )

    return anchors


_CORE = np.dtype([("core", "<u8"), ("more", "<u8"), ("sid", "<i8"), ("at", "<i8"), ("left", "S16"), ("right", "S16"), ("lo", "u1"), ("hi", "u1")])


def _cores(length: int, owners: int):
    """(text, sid, contexts) to blocks of cores for owners."""
    size = length - STEP + 1
    side = STEP - 1

    def cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column("contexts").to_pylist()
            sids = batch.column("sid").to_pylist()
            found = []
            for i, j, data, at in chunks(batch.column("text")):
                (sums, down), other = _sums(data), _other(data)
                padded = np.concatenate([np.zeros(STEP, np.uint8), data, np.zeros(STEP, np.uint8)])
                for r in range(i, j):
                    c = np.frombuffer(asked[r], "<i8").reshape(-1, 3) + at[r - i]
                    n = (c[:, 0] - c[:, 1]) // STEP + 1  # cores of a context, from its anchor down
                    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    anchor, first, last = (np.repeat(c[:, x], n) for x in range(3))
                    core = anchor - STEP * k
                    lo, hi = np.maximum(first, core - side), np.minimum(last, core)
                    ok = lo <= hi
                    core, lo, hi = core[ok], lo[ok], hi[ok]
                    out = np.zeros(len(core), dtype=_CORE)
                    out["core"], out["more"] = _hash(sums, down, core, core + size), _hash(*other, core, core + size)
                    out["sid"], out["at"] = sids[r], core - at[r - i]
                    out["lo"], out["hi"] = lo - (core - side), hi - (core - side)
                    flank = np.arange(side)
                    out["left"] = np.ascontiguousarray(np.pad(padded[(core - side + STEP)[:, None] + flank], ((0, 0), (0, 1)), constant_values=1)).view("S16").ravel()
                    right = np.minimum(core + size + STEP, len(padded) - side)
                    out["right"] = np.ascontiguousarray(np.pad(padded[right[:, None] + flank], ((0, 0), (0, 1)), constant_values=1)).view("S16").ravel()
                    found.append(out)
            every = np.concatenate(found)
            owner = (every["core"] % U(owners)).astype(np.int64)
            order = np.argsort(owner, kind="stable")
            every, owner = every[order], owner[order]
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            parts = [x.tobytes() for x in np.split(every, starts[1:])] if len(starts) else []
            yield pa.RecordBatch.from_arrays([pa.array(owner[starts], pa.int32()), pa.array(parts, pa.binary())], names=["owner", "cores"])

    return cores


def _differ(cores: np.ndarray) -> np.ndarray:
    """Of sorted cores but the first, whether they are unlike the one before."""
    return (cores["core"][1:] != cores["core"][:-1]) | (cores["more"][1:] != cores["more"][:-1])


def _bytes(column: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(column).view(np.uint8).reshape(len(column), 16)[:, : STEP - 1].astype(np.int64)


def repeated(cores: np.ndarray) -> np.ndarray:
    """For each core and each of its STEP strings, whether the string occurs in another core of the array or in an equal one.

    A core with its flanks is a run of 2 * STEP - 1 symbols; `lo` to `hi` are the strings that count.
    """
    order = np.lexsort((cores["more"], cores["core"]))
    new = np.append(True, _differ(cores[order]))
    number = np.empty(len(cores), np.int64)
    number[order] = np.cumsum(new) - 1
    left, right = _bytes(cores["left"]), _bytes(cores["right"])
    flank = np.arange(STEP - 1)
    left[flank < cores["lo"][:, None]] = 256  # outside of the context
    right[flank >= cores["hi"][:, None]] = 256
    rows = np.concatenate([left, 257 + number[:, None], right, np.full((len(cores), 1), 257 + int(new.sum()))], axis=1)
    text = rows.ravel()
    sa = suffix_array(text)
    width = rows.shape[1]
    sa = sa[(sa % width) < STEP]
    sa = sa[(sa % width >= cores["lo"][sa // width]) & (sa % width <= cores["hi"][sa // width])]
    same = np.ones(max(0, len(sa) - 1), dtype=bool)
    for k in range(STEP):
        same &= text[sa[1:] + k] == text[sa[:-1] + k]
    again = np.zeros(len(sa), dtype=bool)
    again[1:] |= same
    again[:-1] |= same
    out = np.zeros((len(cores), STEP), dtype=bool)
    out[sa[again] // width, sa[again] % width] = True
    return out


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, starts and ends (inclusive) of runs of True in each row."""
    wide = np.pad(flags, ((0, 0), (1, 1))).astype(np.int8)
    change = np.diff(wide, axis=1)
    row, start = np.nonzero(change == 1)
    _, end = np.nonzero(change == -1)
    return row, start, end - 1


def _owner(length: int):
    def owner(table: pa.Table) -> pa.Table:
        every = np.concatenate([np.frombuffer(x, _CORE) for x in table.column("cores").to_pylist()])
        every = every[np.lexsort((every["more"], every["core"]))]
        at = np.flatnonzero(np.append(True, _differ(every)))
        size = np.diff(np.append(at, len(every)))
        shared = np.repeat(size > 1, size)
        every, size = every[shared], size[size > 1]
        width, out, a = 2 * STEP, [], 0
        edges = np.cumsum(size)
        while a < len(every):
            fit = np.searchsorted(edges, a + SYMBOLS // width, side="right") - 1
            b = int(edges[fit]) if fit >= 0 and edges[fit] > a else int(edges[np.searchsorted(edges, a, side="right")])
            part = every[a:b]
            row, start, end = _runs(repeated(part))
            first = part["at"][row] - (STEP - 1) + start
            out.append((part["sid"][row], first, part["at"][row] - (STEP - 1) + end + length))
            a = b
        sid, first, last = (np.concatenate(x) for x in zip(*out)) if out else ([], [], [])
        return pa.Table.from_arrays([pa.array(sid, pa.int64()), pa.array(first, pa.int64()), pa.array(last, pa.int64())], names=["sid", "start", "end"])

    return owner


def _strings(length: int):
    """(text, sid, contexts) to every string of the contexts: two hashes, sid, start."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked, sids = batch.column("contexts").to_pylist(), batch.column("sid").to_pylist()
            for i, j, data, at in chunks(batch.column("text")):
                both = _sums(data), _other(data)
                for r in range(i, j):
                    c = np.frombuffer(asked[r], "<i8").reshape(-1, 3)
                    p = np.concatenate([np.arange(a, b + 1) for a, b in c[:, 1:]])
                    h = [_hash(*x, p + at[r - i], p + at[r - i] + length).view(np.int64) for x in both]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, h), pa.array(np.full(len(p), sids[r])), pa.array(p)], names=["h", "more", "sid", "start"])

    return strings


def _pack(kind: str):
    """Rows of a text as one row of packed numbers."""
    names = kind.split()

    def pack(table: pa.Table) -> pa.Table:
        rows = np.stack([table.column(x).to_numpy().astype("<i8") for x in names], axis=1)
        return pa.table({"sid": table.column("sid").slice(0, 1), "contexts": pa.array([rows.tobytes()], pa.binary())})

    return pack


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, spans) to what stays of each text: doc_id, n_bytes, kept, and the removed spans, merged."""
    for batch in batches:
        kept, removed, sizes = [], [], []
        for text, spans in zip(batch.column(1).cast(pa.large_binary()), batch.column(2)):
            data = text.as_py() or b""
            runs: list[list[int]] = []
            if spans.is_valid:
                for start, end in sorted(np.frombuffer(spans.as_py(), "<i8").reshape(-1, 2).tolist()):
                    if runs and start <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], end)
                    else:
                        runs.append([start, end])
            at, parts = 0, []
            for start, end in runs:
                parts.append(data[at:start])
                at = end
            kept.append(b"".join([*parts, data[at:]]))
            removed.append([{"start": a, "end": b} for a, b in runs])
            sizes.append(len(data))
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()), pa.array(removed, spans_type)], names=["doc_id", "n_bytes", "kept", "removed"])


def remove_repeats(docs: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text", hot: int = HOT_CONTEXTS) -> DataFrame:
    """Takes from each text the bytes covered by a string of `length` bytes that also starts elsewhere, in any text or the same.

    Returns doc_id, n_bytes, kept (the remaining bytes, which need not be whole characters) and removed (maximal
    spans as start and end). Strings are judged on the input, do not cross documents, and may overlap. A null text is
    empty; shorter texts lose nothing; of equal texts all copies lose what is long enough; null and repeated doc_ids
    are just carried along; an empty table gives an empty result; other columns are not read. `length` is 272 at
    least. Texts are known by 64-bit hashes meanwhile, strings are equal by 128 bits.
    """
    if length < 2 * ANCHOR + STEP:
        raise ValueError(f"length must be {2 * ANCHOR + STEP} or more")
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("sid"))
    limited = lambda df: sized(df, BROADCAST_ROWS)

    contexts = written(docs.select("sid", "text").mapInArrow(_anchors(length), "sid long, anchor long, first long, last long, key long, context long, more long"), "contexts")
    each = contexts.groupBy("key", "context", "more").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("sid", "anchor")).alias("at"))
    each = written(each, "each-context")
    keys = each.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.sum("copies").alias("all")).filter("all > 1").select("key", "kinds")
    each = written(each.join(written(keys, "keys"), "key").select("key", "context", "more", "copies", "at", "kinds"), "shared-contexts")
    shared = written(contexts.join(each, ["key", "context", "more"]), "shared")
    whole = shared.filter("copies > 1").select("sid", F.col("first").alias("start"), (F.col("last") + length).alias("end"))

    mixed = shared.filter("kinds > 1 and sid = at.sid and anchor = at.anchor").select("sid", "anchor", "first", "last", (F.col("kinds") > hot).alias("hot"))
    mixed = written(mixed.dropDuplicates(["sid", "anchor"]), "mixed")
    many = mixed.groupBy("hot").count().collect()  # two rows at most
    owners = max(partitions(spark) * OWNERS, math.ceil(sum(r["count"] for r in many if not r["hot"]) / OWNER_CONTEXTS))
    names = docs.groupBy("sid").agg(F.min("doc_id").alias("doc_id"))

    def texts(rows: DataFrame) -> DataFrame:
        asked = rows.groupBy("sid").applyInArrow(_pack("anchor first last"), "sid long, contexts binary")
        asked = written(asked.join(names, "sid"), "asked").withColumnsRenamed({"sid": "s", "doc_id": "d"})
        return docs.join(limited(asked), (F.col("sid") == F.col("s")) & F.col("doc_id").eqNullSafe(F.col("d"))).select("text", "sid", "contexts")

    blocks = texts(mixed.filter("not hot")).mapInArrow(_cores(length, owners), "owner int, cores binary")
    some = blocks.groupBy("owner").applyInArrow(_owner(length), "sid long, start long, end long")
    found = whole.unionByName(some)
    if any(r["hot"] for r in many):
        strings = written(texts(mixed.filter("hot")).mapInArrow(_strings(length), "h long, more long, sid long, start long").distinct(), "strings")
        again = strings.groupBy("h", "more").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h", "more")
        found = found.unionByName(strings.join(again, ["h", "more"], "left_semi").select("sid", "start", (F.col("start") + length).alias("end")))
    spans = found.distinct().groupBy("sid").applyInArrow(_pack("start end"), "sid long, contexts binary")
    about = written(spans, "spans").select(F.col("sid").alias("s"), F.col("contexts").alias("spans"))
    out = docs.join(limited(about), F.col("sid") == F.col("s"), "left").select("doc_id", "text", "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, kept binary, removed array<struct<start:long,end:long>>"
    return out.mapInArrow(_cut, schema).withColumnRenamed("doc_id", doc_id)
