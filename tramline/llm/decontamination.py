"""Benchmark decontamination: a broadcast hash set of normalised test n-grams against every window of every document.

DataFrame and SQL functions only. Each word is hashed once; a window's hash is that of its words' hashes, made row by
row in generated code behind an explode, and looked up. Documents with hits are read again and compared word by word;
what the hits say of a document goes back to it. A hit carries the number of its window's set of items, of which
many windows may have the same; the items themselves are joined once for each document and set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import packed, sized, unpacked, written

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Up to so many windows (8 bytes each), or documents with hits, are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    """Words of letters, digits and non-ASCII characters, A-Z as a-z; null has none."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.length(text)  # then lower() is the same, and faster
    return F.array_remove(F.split(F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER)), _BETWEEN), "")


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once in a row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hash(hashes: Column, start: Column, n: int) -> Column:
    """Of n words from `start` (counted from 0)."""
    return F.xxhash64(F.lit(n), *[F.get(hashes, start + k) for k in range(n)])


def windows(benchmark: DataFrame, n: int = 10, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The distinct windows of the items: window (its words, parted by spaces), length, hash k, items (distinct ids as
    text, sorted). An item of fewer words, but not none, is one window."""
    rows = benchmark.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("w")).filter(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(n))
    rows = rows.select("item", length.alias("length"), "w", F.explode(F.sequence(F.lit(1), F.size("w") - length + 1)).alias("i"))
    rows = rows.select("item", "length", F.slice("w", F.col("i"), F.col("length")).alias("w"))
    rows = rows.groupBy("w", "length").agg(F.array_sort(F.collect_set("item")).alias("items"))
    hashes = F.transform("w", lambda x: F.xxhash64(x))
    k = F.coalesce(*[F.when(F.col("length") == m, _hash(hashes, F.lit(0), m)) for m in range(1, n + 1)])
    return rows.select(F.array_join("w", " ").alias("window"), "length", k.alias("k"), "items")


def _near(docs: DataFrame, table: DataFrame, lengths: list[int], doc_id: str, text: str) -> DataFrame:
    """Of documents with a hit by hash: id, hash (of the text), near (a set of i, length, window, items: a number)."""
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("hash"), words(F.col(text)).alias("w"))
    rows = rows.withColumn("h", F.transform("w", lambda x: F.xxhash64(x)))
    starts = F.when(F.size("h") >= min(lengths), F.sequence(F.lit(0), F.size("h") - min(lengths)))
    rows = rows.select("id", "hash", "h", F.explode(starts).alias("i"))
    of = lambda n: F.when(F.col("i") + n <= F.size("h"), _hash(F.col("h"), F.col("i"), n))
    if len(lengths) == 1:
        rows = rows.select("id", "hash", "i", of(lengths[0]).alias("k"))
    else:
        rows = rows.select("id", "hash", "i", F.explode(F.array(*[of(n) for n in lengths])).alias("k"))
    near = rows.join(sized(table.select("k").distinct(), BROADCAST_ROWS), "k", "left_semi")
    near = near.withColumn("i", F.col("i") + 1).join(sized(table, BROADCAST_ROWS), "k")
    return near.groupBy("id", "hash").agg(F.collect_set(F.struct("i", "length", "window", "items")).alias("near"))


def _covered(found: Column) -> Column:
    """Words inside of sorted hits."""
    zero = F.struct(F.lit(1).alias("end"), F.lit(0).cast("long").alias("n"))
    step = lambda a, h: F.struct(
        F.greatest(a["end"], h["i"] + h["length"]).alias("end"), (a["n"] + F.greatest(F.lit(0), h["i"] + h["length"] - F.greatest(a["end"], h["i"]))).alias("n")
    )
    return F.aggregate(found, zero, step, lambda a: a["n"])


def _found(docs: DataFrame, benchmark: DataFrame, n: int, doc_id: str, text: str) -> tuple[DataFrame, DataFrame] | None:
    """A row per document with hits, by id and hash: at (a number of its own), n_hit, sets (numbers), hits; and number and
    items of each set. None if the items have no words."""
    table = written(windows(benchmark, n), "windows")
    sets = written(table.select("items").distinct().select(F.monotonically_increasing_id().alias("number"), "items"), "item-sets")
    table = written(table.join(sets, "items").select("window", "length", "k", F.col("number").alias("items")), "numbered-windows")
    lengths = sorted(r["length"] for r in table.select("length").distinct().collect())  # n of them at most
    if not lengths:
        return None
    near = sized(written(_near(docs, table, lengths, doc_id, text), "near"), BROADCAST_ROWS)
    rows = packed(docs).join(near, _same(doc_id, text))
    verified = lambda w: F.filter("near", lambda h: F.array_join(F.slice(w, h["i"], h["length"]), " ") == h["window"])  # noqa: E731  word by word
    found = rows.select("id", "hash", F.array_sort(_let(words(F.col("row")[text]), verified)).alias("found")).filter(F.size("found") > 0).dropDuplicates(["id", "hash"])
    places = F.transform("found", lambda h: F.struct(h["i"].alias("i"), h["length"].alias("length")))
    found = found.select("id", "hash", F.monotonically_increasing_id().alias("at"), _covered(F.col("found")).alias("n_hit"), F.array_distinct("found.items").alias("sets"), places.alias("hits"))
    return written(found, "hits"), sets


def _with_items(found: DataFrame, sets: DataFrame) -> DataFrame:
    """Documents with hits, with the items of their sets, each once and sorted, for the sets."""
    each = found.select("at", F.explode("sets").alias("number")).join(sized(sets, BROADCAST_ROWS), "number")
    items = each.groupBy("at").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return written(found.join(items, "at").select("id", "hash", "n_hit", "items", "hits"), "hits-with-items")


def _same(doc_id: str, text: str) -> Column:
    return F.col("row")[doc_id].eqNullSafe(F.col("id")) & (F.xxhash64(F.col("row")[text]) == F.col("hash"))


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds to each document _n_words, _n_hit (words inside an occurring window), _items (ids as sorted strings) and
    _hits (first word from 1, and length, of each occurrence).

    A window is n consecutive words of an item; an item of fewer words, but not none, is one window. Hits by hash
    are verified word by word. A null or empty text has no words and no hits; any item_id is taken as its text, a null
    one is not listed, a repeated one once; without items nothing is hit; an empty table gives an empty result; repeated
    rows get equal results. Rows with one doc_id are judged by their own texts. Other columns are carried along; those
    named like an added one are replaced.
    """
    rows, found = packed(docs), _found(docs, benchmark, n, doc_id, text)
    n_words = F.size(words(F.col("row")[text])).cast("long")
    none, nowhere = F.array().cast("array<string>"), F.array().cast("array<struct<i:int,length:int>>")
    if found is None:
        return unpacked(rows, docs.columns, _n_words=n_words, _n_hit=F.lit(0).cast("long"), _items=none, _hits=nowhere)
    out = rows.join(sized(_with_items(*found), BROADCAST_ROWS), _same(doc_id, text), "left")
    return unpacked(out, docs.columns, _n_words=n_words, _n_hit=F.coalesce("n_hit", F.lit(0).cast("long")), _items=F.coalesce("items", none), _hits=F.coalesce("hits", nowhere))


def clean(docs: DataFrame, benchmark: DataFrame, n: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents in which no window of the benchmark occurs, with all their columns; cases as in scan()."""
    found = _found(docs, benchmark, n, doc_id, text)
    if found is None:
        return docs
    return unpacked(packed(docs).join(sized(found[0].select("id", "hash"), BROADCAST_ROWS), _same(doc_id, text), "left_anti"), docs.columns)
