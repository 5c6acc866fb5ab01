"""Self-join of documents by the Jaccard similarity of their word shingles, by a token-group matrix.

1. Every document becomes a set of 64-bit shingle hashes; equal sets are one set from here on.
2. An order of shingles, rare before frequent, gives each set a prefix. Similar sets share so many members of their
   prefixes, however they differ otherwise. Owners of hash ranges count shingles, and then list which sets share a
   shingle of their prefixes.
3. Each set joins the most central set with which it shares much: sets so joined form a group. A set is compared with
   the one it joined; those that links connect to most of their group are its core.
4. The token-group matrix says which groups have a shingle in a member's prefix. A set is a query to other groups
   that it shares a list with; the sum over its row of the matrix bounds what it shares with any member.
5. Only groups whose bound qualifies are opened. Their queries, and their own members outside of the core, are
   compared with their members, block by block; a comparison of blocks returns a forest of links, not all of them.

Shingle hashes travel between partitions as packed blocks, not as rows. A comparison is of whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .exact_dedup import golomb_decode, golomb_encode
from .shared import packed, partitions, row_hash, sized, unpacked, written
from .text import SPACED, U, Words, chunks, grams, mix

#: A shingle in so many documents counts as frequent.
FREQUENT = 32
#: At most so many frequent shingles (5 bytes each) are sent to all tasks: if there are more, the bar is raised.
#: Any order of shingles gives right results; this one keeps lists short.
ORDER_SHINGLES = 2_000_000
#: Up to so many ids of documents are broadcast to pick their rows; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Shingles that a task holds before it sends them.
HELD = 250_000
#: Owners of hash ranges for each partition of a shuffle; a task takes its owners one after the other.
OWNERS = 4
#: Shingles of all documents for an owner, about: with more of them there are more owners, whatever the settings of shuffles.
OWNER_SHINGLES = 5_000_000
#: Places of a task's table of sets that it has sent (a power of two). It saves repeats; owners drop those that it misses.
SENT = 1 << 20
#: Times what similar sets share at least: so much makes a set join another. It decides on groups, not on links.
JOINS = 1
#: Sets in a block, on average, and common shingles that are counted at once.
BLOCK, COUNTED = 512, 1_000_000
#: Prefixes are longer by a SHARE-th of a set than one common shingle would take; then so many are common.
SHARE = 4
#: Bits of a shingle that travel, besides its owner.
BITS = 40


def shingle_sets(column: pa.Array, n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """By chunk: first row, row after the last, sorted (row, hash) of distinct shingles as two arrays."""
    for i, j, data, at in chunks(column):
        w = Words(data, at, SPACED)
        h, row = grams(w.hashes, w.counts, n)
        order = np.lexsort((h, row))
        h, row = h[order], row[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        yield i, j, row[new], h[new]


def digests(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of n rows: sizes of their sets, and a number that equal sets share (sets with equal numbers are taken as equal)."""
    sizes = np.bincount(row, minlength=n)
    total = np.zeros(n, dtype=U)
    full = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[full]
    if len(full):
        total[full] = np.add.reduceat(mix(h ^ U(0x5851F42D4C957F2D)), starts)
    return sizes, mix(total + sizes.astype(U)).view(np.int64)


def _owned(h: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray]:
    return (h % U(owners)).astype(np.int64), h >> U(64 - BITS)


_BLOCK = "owner int, n int, k int, code binary, more binary"
_BLOCK_ARROW = pa.schema([("owner", pa.int32()), ("n", pa.int32()), ("k", pa.int32()), ("code", pa.binary()), ("more", pa.binary())])


def _blocks(owner: np.ndarray, value: np.ndarray, more: np.ndarray) -> pa.RecordBatch:
    """One block for each owner of (value, more), sorted by both, without repeats if `more` is an id."""
    order = np.lexsort((more, value, owner))
    owner, value, more = owner[order], value[order], more[order]
    starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    rows = []
    for a, b in zip(starts.tolist(), np.append(starts[1:], len(owner)).tolist()):
        k, code = golomb_encode(value[a:b], BITS)
        rows.append({"owner": int(owner[a]), "n": int(b - a), "k": k, "code": code, "more": more[a:b].tobytes()})
    return pa.RecordBatch.from_pylist(rows, schema=_BLOCK_ARROW)


def _send_counts(owners: int, n: int):
    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        h, counts = np.unique(np.concatenate(held), return_counts=True)
        return _blocks(*_owned(h, owners), np.minimum(counts, 65_535).astype("<u2"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, _, _, h in shingle_sets(batch.column(0), n):
                held.append(h)
                size += len(h)
                if size >= HELD:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    return send


def _frequent(table: pa.Table) -> pa.Table:
    """An owner's shingles in FREQUENT documents or more, with counts."""
    blocks = table.to_pylist()
    value = np.concatenate([golomb_decode(b["n"], b["k"], b["code"]) for b in blocks])
    count = np.concatenate([np.frombuffer(b["more"], "<u2") for b in blocks])
    order = np.argsort(value, kind="stable")
    value, count = value[order], count[order].astype(np.int64)
    at = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    total = np.add.reduceat(count, at)
    hot = total >= FREQUENT
    owner = pa.array(np.full(int(hot.sum()), blocks[0]["owner"]), pa.int32())
    return pa.Table.from_arrays([owner, pa.array(value[at][hot].astype(np.int64)), pa.array(total[hot])], names=["owner", "value", "docs"])


def prefix_sizes(size: np.ndarray, percent: int) -> np.ndarray:
    """Similar sets a and b have least(need(a), need(b)) common members, or more, in their prefixes of these sizes.

    Their overlap is p = ceil(percent / 100 * size) at least, for either size; so of the common members in their
    order, the first m stand among the first size - p + m of either set.
    """
    return size - -(-size * percent // 100) + size // SHARE + 1


def _need(size: Column, percent: int) -> Column:
    """What a set must share with a similar one, which may be smaller. One shingle less, as two may travel as one."""
    return F.greatest(F.lit(1), F.floor(F.ceil(size * percent / 100) / SHARE)).cast("long")


def _unsent(sent: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Of distinct ids, which are not in the table; they enter it, each at its one place, where a later one replaces it."""
    at = ids & (len(sent) - 1)
    new = sent[at] != ids
    sent[at[new]] = ids[new]
    return new


def _send_prefixes(owners: int, n: int, percent: int, frequent):
    def flush(held: list) -> pa.RecordBatch:
        return _blocks(*_owned(np.concatenate([x[0] for x in held]), owners), np.concatenate([x[1] for x in held]))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, sent = [], 0, ~np.arange(SENT)  # no id is at home where its complement is
        hot = frequent.value
        for batch in batches:
            for i, j, row, h in shingle_sets(batch.column(0), n):
                sizes, ids = digests(row, h, j - i)
                _, first = np.unique(ids, return_index=True)
                take = np.zeros(j - i, dtype=bool)
                first = first[sizes[first] > 0]
                take[first[_unsent(sent, ids[first])]] = True  # equal sets seldom go twice from a task
                keep = take[row]
                row, h = row[keep], h[keep]
                owner, value = _owned(h, owners)
                code = owner.astype(U) << U(BITS) | value
                at = np.searchsorted(hot, code)
                late = (at < len(hot)) & (hot[np.minimum(at, len(hot) - 1)] == code) if len(hot) else np.zeros(len(h), bool)
                order = np.lexsort((h, late, row))
                count = np.where(take, sizes, 0)
                rank = np.arange(len(h)) - np.repeat(np.cumsum(count) - count, count)
                chosen = order[rank < np.minimum(count, prefix_sizes(count, percent))[row]]
                held.append((h[chosen], ids[row[chosen]]))
                size += len(chosen)
                if size >= HELD:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    return send


def _lists(table: pa.Table) -> pa.Table:
    """An owner's lists of two or more sets that share a shingle of their prefixes; of equal lists one, with their number."""
    blocks = table.to_pylist()
    value = np.concatenate([golomb_decode(b["n"], b["k"], b["code"]) for b in blocks])
    ids = np.concatenate([np.frombuffer(b["more"], "<i8") for b in blocks])
    order = np.lexsort((ids, value))
    value, ids = value[order], ids[order]
    new = np.append(True, (value[1:] != value[:-1]) | (ids[1:] != ids[:-1]))
    value, ids = value[new], ids[new]
    at = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    size = np.diff(np.append(at, len(value)))
    at, size = at[size > 1], size[size > 1]
    found: dict[bytes, int] = {}
    for a, s in zip(at, size):
        key = ids[a : a + s].tobytes()
        found[key] = found.get(key, 0) + 1
    number = (blocks[0]["owner"] << 40) + np.arange(len(found))
    return pa.Table.from_arrays(
        [pa.array(number, pa.int64()), pa.array([np.frombuffer(x, "<i8") for x in found], pa.list_(pa.int64())), pa.array(list(found.values()), pa.int64())], names=["list", "sets", "shared"]
    )


def _documents(n: int):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for i, j, row, h in shingle_sets(batch.column(2), n):
                size, digest = digests(row, h, j - i)
                sizes.append(size)
                ids.append(digest)
            size = np.concatenate(sizes)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(np.concatenate(ids), mask=size == 0)], names=["doc_id", "mark", "n_shingles", "set"])

    return describe


def _members(n: int):
    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, row, h in shingle_sets(batch.column(0), n):
                _, digest = digests(row, h, j - i)
                cut = np.searchsorted(row, np.arange(j - i + 1))
                lists = pa.LargeListArray.from_arrays(pa.array(cut, pa.int64()), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(digest), batch.column(1).slice(i, j - i), lists.cast(pa.list_(pa.int64()))], names=["set", "wanted", "shingles"])

    return members


def _similar(percent: int) -> Column:
    both = F.size(F.array_intersect("x", "y"))
    return both * 100 >= (F.size("x") + F.size("y") - both) * percent


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of set numbers whose sets are similar. The end that may be a pivot of many is joined last; both sides
    of that join are plain tables, so that Spark can split it."""
    x = sets.select(F.col("set").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("set").alias("b"), F.col("shingles").alias("y"))
    fits = (F.size("x") * percent <= F.size("y") * 100) & (F.size("y") * percent <= F.size("x") * 100)
    return pairs.join(x, "a").join(y, "b").filter(fits).filter(_similar(percent)).select("a", "b")


def _sets(docs: DataFrame, first: DataFrame, ends: DataFrame, n: int) -> DataFrame:
    """The sets with these numbers, each made from one document that has it."""
    wanted = written(first.join(ends.select("set").distinct(), "set").select("doc_id", F.col("set").alias("wanted")), "wanted")
    few = sized(wanted, BROADCAST_IDS)
    rows = docs.alias("d").join(few.alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id"))).select("d.text", "w.wanted")
    sets = rows.mapInArrow(_members(n), "set long, wanted long, shingles array<long>").filter("set = wanted").drop("wanted")
    sets = written(sets, "shingles")
    return sets if sets.count() == wanted.count() else written(sets.dropDuplicates(["set"]), "shingles")  # rows may be repeated


def forest(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Of edges, those that connect what the ones before them don't."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (y := root.get(x, x)) != x:
            root[x] = x = root.get(y, y)
        return x

    kept = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = find(x), find(y)
        if x != y:
            root[x] = y
            kept.append(i)
    return kept


def _compare(percent: int):
    def compare(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        ids, sets = table.column("set").to_numpy(), table.column("shingles").combine_chunks()
        sizes = np.diff(sets.offsets.to_numpy())
        tokens, row = sets.flatten().to_numpy(), np.repeat(np.arange(len(ids)), sizes)
        right = side[row] == 1
        order = np.argsort(tokens[right], kind="stable")
        there, there_row = tokens[right][order], row[right][order]
        mine, mine_row = tokens[~right], row[~right]
        low, high = np.searchsorted(there, mine, "left"), np.searchsorted(there, mine, "right")
        n, out = high - low, []
        cuts = np.flatnonzero(np.append(True, mine_row[1:] != mine_row[:-1])) if len(mine_row) else np.zeros(0, np.int64)
        ends, a = np.append(cuts[1:], len(mine)), 0
        total = np.append(0, np.cumsum(n))
        while a < len(cuts):  # runs of whole rows of the left side
            b = max(a + 1, int(np.searchsorted(total[ends], total[cuts[a]] + COUNTED, side="right")))
            s, e = int(cuts[a]), int(ends[b - 1])
            k = n[s:e]
            at = np.repeat(low[s:e] - np.append(0, np.cumsum(k)[:-1]), k) + np.arange(int(k.sum()))
            pair = np.repeat(mine_row[s:e], k) * len(ids) + there_row[at]
            pair, both = np.unique(pair, return_counts=True)
            x, y = pair // len(ids), pair % len(ids)
            ok = (both * 100 >= (sizes[x] + sizes[y] - both) * percent) & (ids[x] != ids[y])
            out.append(np.stack([ids[x[ok]], ids[y[ok]]]))
            a = b
        x, y = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
        kept = forest(x, y)
        return pa.table({"a": pa.array(x[kept], pa.int64()), "b": pa.array(y[kept], pa.int64())})

    return compare


def _opened(left: DataFrame, right: DataFrame, sets_of, percent: int) -> DataFrame:
    """Links between the left sets and the right sets of each group, as forests of the blocks that were compared."""
    sets = sets_of(left.select("set").union(right.select("set")))
    counts = left.groupBy("group").agg(F.count(F.lit(1)).alias("l")).join(right.groupBy("group").agg(F.count(F.lit(1)).alias("r")), "group")
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    counts = written(counts.select("group", blocks("l").alias("l"), blocks("r").alias("r")), "block-counts")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("set"), F.col(n)).cast("int")
    rows = left.join(counts, "group").select("group", "set", F.lit(0).alias("side"), own("l").alias("x"), each("r").alias("y"))
    rows = rows.union(right.join(counts, "group").select("group", "set", F.lit(1).alias("side"), each("l").alias("x"), own("r").alias("y")))
    return rows.join(sets, "set").groupBy("group", "x", "y").applyInArrow(_compare(percent), "a long, b long")


def _classes(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of documents (doc_id, text): doc_id, mark (a hash of the text), n_shingles, set (null if empty); and of each set: its component."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    described = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text").mapInArrow(_documents(n), f"doc_id {kind}, mark long, n_shingles long, set long")
    described = written(described, "sets")
    every = described.agg(F.sum("n_shingles")).first()[0] or 0
    owners = max(partitions(spark) * OWNERS, math.ceil(every / OWNER_SHINGLES))
    first = described.filter("set is not null").groupBy("set").agg(F.min("doc_id").alias("doc_id"), F.min("n_shingles").alias("size"))
    first = written(first, "distinct-sets")

    counts = docs.select("text").mapInArrow(_send_counts(owners, n), _BLOCK)
    frequent = written(counts.groupBy("owner").applyInArrow(_frequent, "owner int, value long, docs long"), "frequent")
    bar = FREQUENT
    while (many := frequent.filter(F.col("docs") >= bar)).count() > ORDER_SHINGLES:
        bar *= 2
    hot = np.array([(r["owner"] << BITS) | r["value"] for r in many.select("owner", "value").toLocalIterator()], dtype=U)
    hot = spark.sparkContext.broadcast(np.sort(hot))
    prefixes = docs.select("text").mapInArrow(_send_prefixes(owners, n, percent, hot), _BLOCK)
    lists = written(prefixes.groupBy("owner").applyInArrow(_lists, "list long, sets array<long>, shared long"), "lists")
    exploded = lists.select("list", "shared", F.size("sets").alias("length"), F.explode("sets").alias("set"))
    central = exploded.groupBy("set").agg(F.sum(F.col("shared") * F.col("length")).alias("central"))
    placed = written(exploded.drop("length").join(central.join(first.select("set", "size"), "set"), "set"), "placed")

    # groups: each set joins one that is more central
    pivots = placed.groupBy("list").agg(F.max(F.struct("central", "set")).alias("pivot")).select("list", F.col("pivot.set").alias("b"))
    near = placed.join(pivots, "list").filter("set <> b").groupBy(F.col("set").alias("a"), "size", "b").agg(F.sum("shared").alias("shared"))
    near = near.filter(F.col("shared") >= _need(F.col("size"), percent) * JOINS)
    joined = written(near.groupBy("a").agg(F.max(F.struct("shared", "b")).alias("best")).select("a", F.col("best.b").alias("b")), "joined")
    of = written(components(joined).select(F.col("node").alias("set"), F.col("component").alias("group")), "groups")
    links = written(_verified(joined, _sets(docs, first, joined.select(F.explode(F.array("a", "b")).alias("set")), n), percent), "links")
    parts = components(links).select(F.col("node").alias("set"), F.col("component").alias("part"))
    inside = written(of.join(parts, "set", "left").withColumn("part", F.coalesce("part", "set")), "parts")
    core = inside.groupBy("group", "part").agg(F.count(F.lit(1)).alias("n")).groupBy("group").agg(F.max(F.struct("n", "part")).alias("core"))
    outside = inside.join(written(core, "cores"), "group").filter(F.col("part") != F.col("core.part")).select("group", "set")

    # the matrix, its bound, and the groups that it leaves to open
    grouped = placed.join(of, "set", "left").select("list", "shared", "set", "size", F.coalesce("group", "set").alias("group"))
    mixed = grouped.groupBy("list").agg(F.min("group").alias("g0"), F.max("group").alias("g1")).filter("g0 <> g1").select("list")
    grouped = written(grouped.join(mixed, "list", "left_semi"), "mixed-lists")
    matrix = grouped.select("list", F.col("group").alias("other")).distinct()
    bound = grouped.join(matrix, "list").filter("group > other").groupBy("set", "size", "other").agg(F.sum("shared").alias("shared"))
    queries = bound.filter(F.col("shared") >= _need(F.col("size"), percent)).select(F.col("other").alias("group"), "set")
    left = written(queries.union(outside), "queries")
    members = written(left.select("group").distinct(), "asked-groups").join(of, "group", "left").select("group", F.coalesce("set", "group").alias("set"))
    found = _opened(left, written(members, "members"), lambda ends: _sets(docs, first, ends, n), percent)
    groups = written(components(links.union(written(found, "more-links"))), "components")

    named = first.join(groups.select(F.col("node").alias("set"), "component"), "set", "left").withColumn("component", F.coalesce("component", "set"))
    return described, written(named.select("set", "doc_id", "component"), "named")


def similar_documents(docs: DataFrame, n: int = 5, percent: int = 75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles (distinct), component_id (least doc_id that links reach).

    Words stand between ASCII white space, A-Z as a-z; a text of fewer than n words, but not none, is one shingle.
    Two documents link if the intersection of their sets is at least `percent` of the union. Null, empty and blank texts have no
    shingles and no links: their component_id is their own doc_id. Documents with equal sets are linked; rows with one
    doc_id are judged by their own texts, and all of a component get its least doc_id (nulls don't count, and an
    all-null component gets null). An empty table gives an empty result; other columns are not read.
    """
    described, named = _classes(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), n, percent)
    ids = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    ids = written(named.select("set", "component").join(ids, "component").select("set", "component_id"), "component-ids")
    out = described.join(ids, "set", "left")
    return out.select(F.col("doc_id").alias(doc_id), "n_shingles", F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, and those without shingles, with the columns as they were.

    The row with the least doc_id stays (null after all others); of several texts with that doc_id in a component, that of
    the least hash; of repeated rows with that text, that of the largest hash of the row as JSON. Rows are removed by doc_id and text,
    so a row that is similar to nothing stays whatever its doc_id. Other cases are as in similar_documents().
    """
    described, named = _classes(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), n, percent)
    rows = described.filter("set is not null").select("doc_id", "mark", "set").join(named.select("set", "component"), "set")
    best = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("best"), F.count(F.lit(1)).alias("n"))
    best = written(best.filter("n > 1").select("component", F.col("best.doc_id").alias("best_id"), F.col("best.mark").alias("best_mark")), "best")
    rows = rows.join(sized(best, BROADCAST_IDS), "component").withColumn("stays", F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("mark") == F.col("best_mark")))
    groups = written(rows.groupBy("doc_id", "mark").agg(F.first("stays").alias("stays"), F.count(F.lit(1)).alias("n")).filter("not stays or n > 1"), "near")

    own = lambda t: F.col("row")[doc_id].eqNullSafe(t["doc_id"]) & (F.xxhash64(F.col("row")[text]) == t["mark"])
    left = packed(docs).join(sized(groups, BROADCAST_IDS), own(groups), "left_anti")
    again = groups.filter("stays")
    if not again.isEmpty():
        twice = packed(docs).join(sized(again, BROADCAST_IDS), own(again), "left_semi")
        left = left.unionAll(twice.groupBy(F.col("row")[doc_id].alias("i"), F.xxhash64(F.col("row")[text]).alias("m")).agg(F.max_by("row", row_hash("row")).alias("row")).select("row"))
    return unpacked(left, docs.columns)
