"""Each operator against a brute-force version, on documents with awkward cases."""

import binascii
import collections
import hashlib
import math
import re
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from tramline.llm import components, decontamination, exact_dedup, jaccard_join, lm_scoring, packing, queries, sharding, span_dedup, suffix_array, suffix_dedup, token_counts, toxicity
from tramline.llm.text import SPACED, Words, chunks, grams

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def pairs(docs):
    return [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]


# sharding


@pytest.mark.parametrize("bucket_bytes", [32 << 20, 20_000])
def test_shards_are_even_and_keep_every_row(docs, texts, bucket_bytes):
    out = sharding.shard(docs, 16, bucket_bytes=bucket_bytes)
    assert out.columns == [*docs.columns, "_shard", "_slot"]
    rows = out.collect()
    assert sorted((r["doc_id"], r["text"] or "", r["a.b"]) for r in rows) == sorted((r["doc_id"], r["text"] or "", r["a.b"]) for r in docs.collect())
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["_shard"]].append(r["_slot"])
    assert set(slots) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    assert rows != sorted(rows, key=lambda r: (r["_shard"], r["doc_id"]))


def test_buckets_share_tasks(docs, monkeypatch):
    """More buckets than tasks: the same result as with a task each."""
    each = sharding.shard(docs, shards=5, bucket_bytes=3_000).select("doc_id", "_shard", "_slot").collect()
    monkeypatch.setattr(sharding, "REDUCERS", 1)
    monkeypatch.setattr(sharding, "partitions", lambda spark: 3)
    few = sharding.shard(docs, shards=5, bucket_bytes=3_000).select("doc_id", "_shard", "_slot")
    assert sorted(few.collect()) == sorted(each)


def test_sharding_is_repeatable_and_seeded(docs):
    place = lambda seed: {(r["doc_id"]): (r["_shard"], r["_slot"]) for r in sharding.shard(docs.select("doc_id", "text"), 16, seed=seed).collect()}
    assert place(1) == place(1) != place(2)


def test_sharding_of_odd_tables(odd, empty):
    assert sharding.shard(empty).count() == 0
    assert sorted(r["_slot"] for r in sharding.shard(odd, 2).collect()) == [0, 0, 1, 1, 2, 2, 3, 3]
    assert len(sharding.shard(odd, 16).collect()) == 8


def test_fisher_yates_is_uniform():
    seen = collections.Counter(tuple(sharding.fisher_yates(3, [1, k])) for k in range(3000))
    assert len(seen) == 6 and min(seen.values()) > 400


# n-gram Jaccard join


def brute_components(rows, n=5, percent=75):
    sets = []
    for _, t in rows:
        w = t.translate(LOWER).split()
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    return sorted((str(d), len(sets[i]), str(min((x for x in least[find(i)] if x is not None), default=None))) for i, (d, _) in enumerate(rows))


def test_jaccard_join_finds_components(docs):
    out = jaccard_join.similar_documents(docs).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in out) == brute_components(pairs(docs))


def test_jaccard_join_with_owners_by_shingles(docs, monkeypatch):
    """Owners follow the number of shingles, and a table of sent sets that is too small changes nothing."""
    monkeypatch.setattr(jaccard_join, "OWNER_SHINGLES", 150)
    monkeypatch.setattr(jaccard_join, "SENT", 4)
    used = []
    send = jaccard_join._send_counts
    monkeypatch.setattr(jaccard_join, "_send_counts", lambda owners, n: used.append(owners) or send(owners, n))
    out = jaccard_join.similar_documents(docs).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in out) == brute_components(pairs(docs))
    assert used == [-(-sum(r["n_shingles"] for r in out) // 150)]


def test_table_of_sent_sets():
    sent = ~np.arange(8)
    assert jaccard_join._unsent(sent, np.array([0, 7, -1, 9])).tolist() == [True] * 4  # 7 and -1 have one place
    assert jaccard_join._unsent(sent, np.array([0, 9, -1, 5])).tolist() == [False, False, False, True]
    assert jaccard_join._unsent(sent, np.array([7, 1])).tolist() == [True, True]


def test_jaccard_join_of_many_variants(spark, monkeypatch):
    """A chain and a cloud of variants around one text, with small blocks and few frequent shingles allowed."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 3)
    monkeypatch.setattr(jaccard_join, "COUNTED", 500)
    monkeypatch.setattr(jaccard_join, "ORDER_SHINGLES", 40)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(60):
        w = list(base)
        for _ in range(int(rng.integers(0, 5))):
            w[int(rng.integers(0, 60))] = f"v{rng.integers(0, 9)}"
        rows.append((100 - k, " ".join(w)))
    rows += [(200 + k, " ".join(f"w{i}" for i in range(k * 3, k * 3 + 50))) for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = jaccard_join.similar_documents(df).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in out) == brute_components(pairs(df))


def test_jaccard_join_of_odd_tables(odd, empty):
    assert jaccard_join.similar_documents(empty).count() == 0
    out = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.similar_documents(odd).collect()}
    assert (5, 116, 5) in out and (6, 116, 5) in out and (None, 116, 5) in out and (7, 0, 7) in out and (None, 0, None) in out and (None, 2, None) in out


def test_keep_one_of_near_copies(docs):
    kept = jaccard_join.keep_one(docs)
    want = {int(d) for d, _, c in brute_components(pairs(docs)) if d == c}
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(want)


def test_keep_one_removes_rows_not_ids(spark, odd, empty):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(5, a, 1), (5, b, 2), (3, b, 3), (3, b, 4), (9, b.upper() + "  c", 5), (None, a + " x", 6), (None, "odd one out", 7), (8, None, 8), (8, None, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _gone int")
    for part in (rows, rows[:3]):
        out = jaccard_join.keep_one(df.filter(F.col("_gone").isin([r[2] for r in part])))
        want = [1, 4, 7, 8, 9] if len(part) > 3 else [1, 3]
        assert out.columns == df.columns and sorted(r["_gone"] for r in out.collect()) == want
    tie = spark.createDataFrame([(1, b), (1, b + " c"), (1, b + " d")], "doc_id long, text string")
    assert jaccard_join.keep_one(tie).count() == 1
    assert jaccard_join.keep_one(empty).count() == 0
    kept = jaccard_join.keep_one(odd)
    assert sorted((str(r["doc_id"]), (r["text"] or "")[:5]) for r in kept.collect()) == [("5", "other"), ("5", "w0 w1"), ("7", ""), ("None", ""), ("None", "a b c")]


def test_grams_match_words():
    import pyarrow as pa

    texts = ["a b c", "b c d e", None, "", "x", "a  b\tc"]
    for _, _, data, at in chunks(pa.array(texts)):
        w = Words(data, at, SPACED)
        h, row = grams(w.hashes, w.counts, 2)
    assert row.tolist() == [0, 0, 1, 1, 1, 4, 5, 5] and h[0] == h[6] and h[1] == h[7] == h[2] and len(set(h.tolist())) == 5


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100 + i, 100) for i in range(1, 9)] + [(-5, 300), (7, 7)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(9)} | {-5: -5, 300: -5}


# suffix arrays


def test_suffix_array():
    rng = np.random.default_rng(1)
    for _ in range(1500):
        s = rng.integers(0, rng.integers(1, 5), rng.integers(0, 40)).tolist()
        assert suffix_array.suffix_array(np.array(s, dtype=np.int64)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def brute_repeats(rows, length=400):
    seen = collections.Counter(t[p : p + length] for _, t in rows for p in range(len(t) - length + 1))
    out = []
    for d, t in rows:
        cover, end = bytearray(len(t)), 0
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                for q in range(max(p, end), p + length):
                    cover[q] = 1
                end = p + length
        spans = sum(c and (not q or not cover[q - 1]) for q, c in enumerate(cover))
        out.append((str(d), len(t), sum(cover), spans, hashlib.sha256(bytes(x for x, c in zip(t, cover) if not c)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot", [suffix_dedup.HOT_CONTEXTS, 1])
def test_repeats_are_removed_byte_for_byte(docs, hot):
    docs = docs.filter(F.length("text") < 20_000).unionByName(docs.filter("text is null"))
    out = suffix_dedup.remove_repeats(docs, hot=hot).collect()
    got = sorted((str(r["doc_id"]), r["n_bytes"], sum(s["end"] - s["start"] for s in r["removed"]), len(r["removed"]), hashlib.sha256(r["kept"]).hexdigest()) for r in out)
    assert got == brute_repeats(pairs(docs))


def test_repeats_in_very_long_texts(spark):
    rng = np.random.default_rng(9)
    long = "".join(map(chr, rng.integers(97, 123, 600_000)))
    rows = [(1, long), (2, "x" * 100 + long[300_000:300_500] + "y" * 1_000_000), (3, "ab" * 200_000)]
    out = {r["doc_id"]: r["removed"] for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    spans = {d: [(s["start"], s["end"]) for s in x] for d, x in out.items()}
    assert spans == {1: [(300_000, 300_500)], 2: [(100, 600 + 1_000_000)], 3: [(0, 400_000)]}


def test_passages_of_over_50_words_go_from_400_bytes_on(spark):
    rng = np.random.default_rng(12)
    word = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    short, long = (" ".join(word(6) for _ in range(60))[:n] for n in (399, 400))
    assert min(len(short.split()), len(long.split())) > 50
    rows = [(1, f"{word(50)}<{short}>{word(500)}"), (2, f"{word(700)}({short}){word(90)}"), (3, f"{word(50)}<{long}>{word(500)}"), (4, f"{word(700)}({long}){word(90)}"), (5, word(900))]
    out = {r["doc_id"]: r["removed"] for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: [(s["start"], s["end"]) for s in x] for d, x in out.items()} == {1: [], 2: [], 3: [(51, 451)], 4: [(701, 1101)], 5: []}


def test_repeats_in_odd_tables(odd, empty):
    assert suffix_dedup.remove_repeats(empty).count() == 0
    got = sorted((str(r["doc_id"]), len(r["kept"])) for r in suffix_dedup.remove_repeats(odd).collect())
    assert got == sorted((d, k) for d, *_, k in [("None", 11), ("None", 0), ("5", 0), ("5", 0), ("5", 29), ("6", 0), ("None", 0), ("7", 0)])
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(odd, length=100)


# spans of sentences


def split(text, longest):
    """Words, and sentences as lists of words."""
    out, now = [], []
    for m in re.finditer(rb"[^\x20\x09-\x0D]+", text):
        if now and b"\n" in text[end : m.start()]:
            out.append(now)
            now = []
        now.append(m.group().translate(LOWER))
        end = m.end()
        if m.group()[-1:] in b".!?" or len(now) == longest:
            out.append(now)
            now = []
    return out + [now] * bool(now)


def brute_spans(rows, sentences=3, words=25, longest=12):
    first, where = {}, collections.defaultdict(list)
    parts = {d: split(t, longest) for d, t in rows}
    for d in sorted(parts):
        s = parts[d]
        for i in range(len(s)):
            j, n = i, 0
            while j < len(s) and (j - i < sentences or n < words):
                n, j = n + len(s[j]), j + 1
            if j - i >= sentences and n >= words:
                where[b" ".join(sum(s[i:j], []))].append((d, i, j))
    gone = collections.defaultdict(set)
    for places in where.values():
        for d, i, j in sorted(places)[1:]:
            gone[d] |= set(range(i, j))
    return sorted((d, len(s), len(gone[d]), b" ".join(w for i, x in enumerate(s) if i not in gone[d] for w in x)) for d, s in parts.items())


def test_repeated_spans_are_removed(docs):
    out = span_dedup.remove_spans(docs).collect()
    got = sorted((r["doc_id"], r["n_sentences"], r["n_removed"], b" ".join(r["text"].encode().translate(LOWER).split())) for r in out)
    assert got == brute_spans(pairs(docs))
    untouched = {r["doc_id"]: r["text"] for r in out if not r["n_removed"]}
    assert all(untouched.get(d, t.decode()) == t.decode() for d, t in pairs(docs))


def test_spans_of_odd_tables(odd, empty):
    assert span_dedup.remove_spans(empty).count() == 0
    got = collections.Counter((r["doc_id"], r["n_sentences"], r["n_removed"]) for r in span_dedup.remove_spans(odd).collect())
    assert got == {(None, 1, 0): 1, (None, 0, 0): 1, (None, 10, 0): 1, (5, 10, 10): 2, (5, 1, 0): 1, (6, 10, 10): 1, (7, 0, 0): 1}


def word_hashes(words):
    import pyarrow as pa

    for _, _, data, at in chunks(pa.array([b" ".join(words).decode()])):
        return Words(data, at, SPACED).hashes.tolist()


def split_by_content(text, longest=12):
    out = []
    for s in split(text, 1 << 30):
        cuts = set()
        if len(s) > longest:
            h = word_hashes(s)
            cuts = {min(range(i, i + longest), key=lambda k: (h[k], -k)) + 1 for i in range(len(s) - longest + 1)}
        edges = sorted(cuts | {0, len(s)})
        out += [s[a:b] for a, b in zip(edges, edges[1:])]
    return out


def brute_content_spans(rows, sentences=3, words=25):
    where = collections.defaultdict(set)
    parts = {d: split_by_content(t) for d, t in rows}
    for d, s in parts.items():
        ok = lambda i, j: j - i >= sentences and sum(map(len, s[i:j])) >= words
        for i in range(len(s)):
            runs = [next(((i, j) for j in range(i + sentences, len(s) + 1) if ok(i, j)), None), next(((k, i + 1) for k in range(i, -1, -1) if ok(k, i + 1)), None)]
            for a, b in filter(None, runs):
                where[b" ".join(sum(s[a:b], []))].add((d, a, b))
    gone = collections.defaultdict(set)
    for places in where.values():
        for d, i, j in sorted(places)[1:]:
            gone[d] |= set(range(i, j))
    return sorted((d, len(s), len(gone[d]), b" ".join(w for i, x in enumerate(s) if i not in gone[d] for w in x)) for d, s in parts.items())


def test_spans_by_content(docs):
    out = span_dedup.remove_spans(docs.filter("text is null or length(text) < 20000"), by_content=True).collect()
    got = sorted((r["doc_id"], r["n_sentences"], r["n_removed"], b" ".join(r["text"].encode().translate(LOWER).split())) for r in out)
    assert got == brute_content_spans([(d, t) for d, t in pairs(docs) if len(t) < 20_000])


def test_passages_without_stops_are_found_at_any_offset(spark, tmp_path):
    """Passages of 50 and more words behind and before other words without a stop; real sentences of odd lengths, to the last one."""
    rows, keep = [], {}
    for k in range(60):
        passage = [f"p{k}x{i}" for i in range(50 + k % 30)]
        rows += [(10 * k + c, " ".join([f"b{k}y{c}z{i}" for i in range(5 * c + k % 12)] + passage + [f"a{k}y{c}z{i}" for i in range(7 * c + 1)])) for c in (0, 1)]
        keep[10 * k + 1] = set(passage)
    lengths = [[12, 12, 4, 8], [9, 11, 5, 3, 6, 10], [8, 9, 9, 2]]
    for k, sizes in enumerate(lengths):
        passage = " ".join(" ".join(f"s{k}x{i}y{j}" for j in range(n)) + "." for i, n in enumerate(sizes))
        rows += [(1000 + 10 * k + c, f"Head of {k} in {c}. {passage} Some other end of {k} in {c} here.") for c in (0, 1)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = {r["doc_id"]: r["text"].split() for r in queries.op4_span_dedup(spark, str(tmp_path)).collect()}
    assert all(out[d] == t.split() for d, t in rows if d % 10 == 0)
    assert all(len(words & set(out[d])) < 24 for d, words in keep.items())
    assert all(out[1001 + 10 * k] == f"Head of {k} in 1. Some other end of {k} in 1 here.".split() for k in range(3))


# LM scoring


def plain_score(model, text):
    """One word at a time."""
    import pyarrow as pa

    p, n = lm_scoring.unpack(model.flat), lm_scoring.CLASSES
    for _, _, data, at in chunks(pa.array([text])):
        ids, _, _ = lm_scoring.symbols(data, at, model.common)
    total = 0.0
    for t, s in enumerate(ids):
        h = p["bias"].astype(float)
        for c, o in enumerate([-2, -1, 1, 2]):
            h = h + p["embed"][c][ids[t + o] if 0 <= t + o < len(ids) else n * n]
        h = np.tanh(h)
        a, b = divmod(int(s), n)
        one, two = h @ p["w1"] + p["b1"], h @ p["w2"][a] + p["b2"][a]
        total += one[a] - np.log(np.exp(one).sum()) + two[b] - np.log(np.exp(two).sum())
    return total


def test_lm_scores(docs, odd, empty, spark):
    model = lm_scoring.train(docs)
    assert not np.array_equal(model.flat, lm_scoring.untrained(lm_scoring.words(docs)).flat) and np.isfinite(model.flat).all()
    rows = {r["doc_id"]: r for r in lm_scoring.score(docs, model).collect()}
    for d, t in pairs(docs)[:30]:
        if 0 < len(t) < 5000:
            assert math.isclose(rows[d]["log_likelihood"], plain_score(model, t.decode()), rel_tol=1e-3, abs_tol=1e-2)
        if not t.strip():
            assert rows[d]["n_words"] == 0 and rows[d]["log_likelihood"] == 0 and rows[d]["per_word"] is None
    assert lm_scoring.score(empty, lm_scoring.train(empty)).count() == 0
    assert lm_scoring.score(odd, model).count() == 8


def test_lm_prefers_text_like_the_corpus(spark):
    rng = np.random.default_rng(2)
    order = {w: [f"n{(w * 7 + k) % 40}" for k in (1, 2)] for w in range(40)}

    def text(n):
        out = ["n0"]
        while len(out) < n:
            out.append(order[int(out[-1][1:])][int(rng.integers(0, 2))])
        return out

    rows = [(i, " ".join(text(60))) for i in range(400)]
    held = [text(60) for _ in range(30)]
    corpus = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    model, counted = lm_scoring.train(corpus), lm_scoring.words(corpus)
    tests = [(i, " ".join(w)) for i, w in enumerate(held)] + [(100 + i, " ".join(rng.permutation(w))) for i, w in enumerate(held)]
    got = {r["doc_id"]: r["log_likelihood"] for r in lm_scoring.score(spark.createDataFrame(tests, "doc_id long, text string"), model).collect()}
    assert sum(got[i] > got[100 + i] for i in range(30)) >= 28
    n = {r["h"]: r["n"] for r in counted.collect()}
    by_counts = sum(math.log(n[int(h)] / sum(n.values())) for w in held for h in Words(*next(chunks(__import__("pyarrow").array([" ".join(w)])))[2:], lm_scoring.LETTERS).hashes.view(np.int64))
    whole = {r["doc_id"]: r["log_likelihood"] for r in lm_scoring.score(spark.createDataFrame(tests[:30], "doc_id long, text string"), model, counted=counted).collect()}
    assert sum(whole.values()) > by_counts + 0.5 * 30 * 60  # on rows that it has not seen, a word


def test_training_does_not_depend_on_partitions(docs, monkeypatch):
    monkeypatch.setattr(lm_scoring, "COPY_BYTES", 40_000)
    one, many = (lm_scoring.train(docs.repartition(n, *by)) for n, by in ((1, ()), (5, ("lang",))))
    assert np.array_equal(one.common, many.common) and np.allclose(one.flat, many.flat, atol=1e-4)
    monkeypatch.setattr(lm_scoring, "TASKS", 1)  # all copies in one task, one after the other
    assert np.allclose(one.flat, lm_scoring.train(docs).flat, atol=1e-2)


def test_a_step_of_training_is_that_of_the_plain_network():
    """Against derivatives word by word."""
    rng = np.random.default_rng(4)
    n, c = 7, lm_scoring.CLASSES
    flat = rng.normal(0, 0.3, len(lm_scoring.initial())).astype(np.float32)
    ids, around = rng.integers(0, c * c, n), rng.integers(0, c * c + 1, (n, len(lm_scoring._OFFSETS)))
    around[3] = around[2]
    before = {k: v.astype(float) for k, v in lm_scoring.unpack(flat.copy()).items()}
    grads, logs = {k: np.zeros_like(v) for k, v in before.items()}, []
    for t, x in zip(ids, around):
        a, b = divmod(int(t), c)
        h = np.tanh(before["bias"] + sum(before["embed"][o][w] for o, w in enumerate(x)))
        back, log = np.zeros_like(h), 0.0
        for w, bias, own in (("w1", before["b1"], a), ("w2", before["b2"][a], b)):
            weights, grad = (before[w], grads[w]) if w == "w1" else (before[w][a], grads[w][a])
            z = h @ weights + bias
            q = np.exp(z) / np.exp(z).sum()
            log += np.log(q[own])
            g = q - (np.arange(c) == own)
            grad += np.outer(h, g)
            if w == "w1":
                grads["b1"] += g
            else:
                grads["b2"][a] += g
            back += weights @ g
        back *= 1 - h * h
        grads["bias"] += back
        for o, w in enumerate(x):
            grads["embed"][o][w] += back
        logs.append(log)
    p, squares = lm_scoring.unpack(flat), {k: np.full(s, 1.0, np.float32) for k, s in lm_scoring._SQUARES.items()}
    assert np.allclose(lm_scoring.log_probabilities(p, ids, around), logs, atol=1e-4)
    lm_scoring.learn(p, squares, ids, around)
    for k, g in grads.items():
        g = g / np.sqrt(n)
        square = (g * g).mean(axis=-1, keepdims=True) if k == "embed" else g * g
        assert np.allclose(p[k], before[k] - lm_scoring.RATE * g / np.sqrt(1 + square), atol=1e-4), k


def test_parameters_of_all_classes_are_stepped_together():
    """A step calls few functions beside two products a class; without that, most of its CPU seconds aren't arithmetic."""
    rng, n = np.random.default_rng(6), lm_scoring.CLASSES**2
    state = np.concatenate([lm_scoring.initial(), lm_scoring.squares_at_first()])
    p, squares = lm_scoring.unpack(state), lm_scoring.unpack(state[lm_scoring._SIZE :], lm_scoring._SQUARES)
    called = collections.Counter()
    sys.setprofile(lambda frame, event, what: called.update([event]))
    try:
        lm_scoring.learn(p, squares, rng.permutation(n), rng.integers(0, n + 1, (n, 4)))
    finally:
        sys.setprofile(None)
    assert called["call"] + called["c_call"] < 4 * lm_scoring.CLASSES


@pytest.mark.parametrize("block", [lm_scoring.BLOCK, 50])
def test_lm_scores_are_of_words(spark, docs, odd, empty, monkeypatch, block):
    """The network's score of symbols and, by counts over all texts, each rarer word's share of its symbol; a table that grows with the words."""
    monkeypatch.setattr(lm_scoring, "BLOCK", block)
    counted = lm_scoring.words(docs)
    model = lm_scoring.untrained(counted)
    n = collections.Counter(w for _, t in pairs(docs) for w in plain_words(t))
    assert counted.count() == len(n) and sorted(r["n"] for r in counted.collect()) == sorted(n.values())
    hashes = Words(*next(chunks(__import__("pyarrow").array([b" ".join(n).decode()])))[2:], lm_scoring.LETTERS).hashes
    symbol = {w: int(h >> np.uint64(52)) % lm_scoring.SHARED for w, h in zip(n, hashes) if n[w] < lm_scoring.COMMON_COUNT}
    assert 0 < len(symbol) < len(n) and sorted(model.common.tolist()) == sorted(int(h) for w, h in zip(n, hashes) if w not in symbol)
    total = collections.Counter()
    for w in symbol:
        total[symbol[w]] += n[w]
    classes = {r["doc_id"]: r["log_likelihood"] for r in lm_scoring.score(docs, model).collect()}
    rows = {r["doc_id"]: r for r in lm_scoring.score(docs, model, counted=counted).collect()}
    assert len(rows) == len(classes)
    for d, t in pairs(docs):
        words = plain_words(t)
        assert rows[d]["n_words"] == len(words)
        want = classes[d] + sum(math.log(n[w] / (total[symbol[w]] + 1)) for w in words if w in symbol)
        assert math.isclose(rows[d]["log_likelihood"], want, rel_tol=1e-6, abs_tol=1e-6)
    assert lm_scoring.score(empty, model, counted=lm_scoring.words(empty)).count() == 0
    assert lm_scoring.score(odd, model, counted=counted).count() == lm_scoring.score(odd, model, counted=lm_scoring.words(empty)).count() == 8


def test_rare_words_score_below_common_ones_of_their_class(spark, tmp_path):
    by_symbol = collections.defaultdict(list)
    for i in range(9000):
        by_symbol[int(Words(np.frombuffer(f"w{i}".encode(), np.uint8), np.array([0, len(f"w{i}")]), lm_scoring.LETTERS).hashes[0] >> np.uint64(52))].append(f"w{i}")
    common, rare = next(x for x in by_symbol.values() if len(x) > 1)[:2]
    rows = [(i, f"the {common} is here") for i in range(7)] + [(99, f"the {rare} is here")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r["log_likelihood"] for r in queries.op5_lm_scoring(spark, str(tmp_path)).collect()}
    assert math.isclose(got[0] - got[99], math.log(7), rel_tol=1e-3)


# benchmark decontamination


def plain_words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or b"").translate(LOWER))


def brute_hits(rows, items, n=10):
    test = collections.defaultdict(set)
    for i, t in items:
        w = plain_words(t)
        m = min(n, len(w))
        for k in range(len(w) - m + 1) if w else ():
            test[tuple(w[k : k + m])].add(str(i))
    out = []
    for d, t in rows:
        w, hit, ids = plain_words(t), set(), set()
        for m in {len(g) for g in test}:
            for k in range(len(w) - m + 1):
                if tuple(w[k : k + m]) in test:
                    hit |= set(range(k, k + m))
                    ids |= test[tuple(w[k : k + m])]
        out.append((str(d), len(w), len(hit), sorted(ids)))
    return sorted(out)


@pytest.fixture(params=["broadcast", "shuffle"])
def way(request, spark, monkeypatch):
    """Joins of benchmark windows and of hits, by broadcast and by shuffle."""
    if request.param == "shuffle":
        monkeypatch.setattr(decontamination, "BROADCAST_ROWS", -1)
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        yield
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    else:
        yield


def test_decontamination(spark, docs, texts, way):
    w = texts[2].split() + texts[3].split()
    items = [(1, " ".join(w[:14]).upper()), (2, "«" + "-".join(w[6:17]) + "»"), (3, "ONE, two!"), (3, None), (10, ""), (12, "never seen before in any of these documents at all"), (None, " ".join(w[20:31])), (13, "word " * 12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontamination.scan(docs, bench)
    got = sorted((str(r["doc_id"]), r["_n_words"], r["_n_hit"], list(r["_items"])) for r in out.collect())
    want = [(d, n, h, [x for x in ids if x != "None"]) for d, n, h, ids in brute_hits(pairs(docs), [(i, (t or "").encode()) for i, t in items])]
    assert got == want and any(h for _, _, h, _ in got) and max(n for _, n, *_ in got) == 30_000
    assert sorted(r["doc_id"] for r in decontamination.clean(docs, bench).collect()) == sorted(int(d) for d, _, h, _ in got if not h)


@pytest.mark.parametrize("ids, kind", [(["a,b", "a", "line\nbreak", "", " x "], "string"), ([0.5, 1e9, 2.0], "double"), ([7, 11, 9], "int")])
def test_item_ids_are_kept_as_they_are(spark, way, ids, kind):
    """Also ids with commas and line breaks, and empty ones."""
    text = " ".join(f"w{i}" for i in range(40))
    bench = spark.createDataFrame([(x, " ".join(f"w{i}" for i in range(k, k + 11))) for k, x in enumerate(ids)], f"item_id {kind}, text string")
    want = sorted(r[0] for r in bench.selectExpr("cast(item_id as string)").collect())
    one, none = decontamination.scan(spark.createDataFrame([(1, text), (2, "w1 w2")], "doc_id long, text string"), bench).orderBy("doc_id").collect()
    assert one["_items"] == want and one["_n_hit"] == 10 + len(ids) and none["_items"] == [] and none["_n_hit"] == 0


def test_windows_that_very_many_items_have(spark, way):
    """Hits carry the number of a set of items, never the items; a document's items are complete."""
    common, own = " ".join(f"c{i}" for i in range(14)), lambda k: " ".join(f"own{k}x{i}" for i in range(10))
    bench = spark.createDataFrame([(k, f"{common} {own(k)}") for k in range(300)] + [(900, own(900))], "item_id long, text string")
    docs = spark.createDataFrame([(k, f"a {common} b" if k % 2 else f"{own(k)} . {own(900)}") for k in range(20)], "doc_id long, text string")
    table = decontamination.windows(bench)
    assert table.filter(F.size("items") == 300).count() == 5
    rows = {r["doc_id"]: r for r in decontamination.scan(docs, bench).collect()}
    every = sorted(str(k) for k in range(300))
    assert all(list(rows[k]["_items"]) == (every if k % 2 else sorted([str(k), "900"])) for k in range(20))
    assert all(rows[k]["_n_hit"] == (14 if k % 2 else 20) for k in range(20))
    found, sets = decontamination._found(docs, bench, 10, "doc_id", "text")
    assert dict(found.dtypes)["sets"] == "array<bigint>" and found.filter("size(sets) > 2").count() == 0
    assert sets.count() == 302  # one of all 300, one of each, one of 900


def test_decontamination_of_odd_tables(spark, odd, empty, way):
    bench = spark.createDataFrame([(1, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.scan(empty, bench).count() == decontamination.clean(empty, bench).count() == 0
    assert [r["_n_hit"] for r in decontamination.scan(odd, none).collect()] == [0] * 8 and decontamination.clean(odd, none).count() == 8
    assert sorted(r["_n_hit"] for r in decontamination.scan(odd, bench).collect()) == [0] * 4 + [11] * 4
    assert sorted(str(r["doc_id"]) for r in decontamination.clean(odd, bench).collect()) == ["5", "7", "None", "None"]


# token counts


def test_token_counts(docs, odd, empty):
    import public_tokenizers as P
    import regex

    ranks = queries.tokenizer_files()[0]
    vocabulary = token_counts.Vocabulary(ranks)
    few = docs.filter(F.coalesce(F.length("text"), F.lit(0)) < 5_000)
    out = {r["doc_id"]: (r["n_pretokens"], r["n_tokens"]) for r in token_counts.token_counts(few, ranks, P.PATTERN).collect()}
    for d, t in pairs(few):
        words = regex.findall(P.PATTERN, t.decode())
        assert out[d] == (len(words), sum(vocabulary.one(w.encode()) for w in words))
    words = sorted({x.astype(np.uint8).tobytes() for x in np.random.default_rng(1).integers(97, 102, (400, 9))} | {b"ab", b"abc", b"a"})
    assert vocabulary.trie(words).tolist() == [vocabulary.one(w) for w in words]
    assert token_counts.token_counts(empty, ranks, P.PATTERN).count() == 0 and token_counts.token_counts(odd, ranks, P.PATTERN).count() == 8


def test_cheapest_segmentation():
    vocabulary = token_counts.Vocabulary(queries.tokenizer_files()[0])

    def best(word):
        if not word:
            return (0, 0)
        found = [(lambda r: (r[0] + (c >> 20), r[1] + 1))(best(word[:-k])) for k in range(1, len(word) + 1) if (c := vocabulary.costs.get(word[-k:])) is not None]
        return min(found)

    for w in (b"the", b"unhappy", b"zqxj", "straße".encode()):
        assert vocabulary.one(w) == best(w)[1]


def test_long_pieces_and_long_pre_tokens(spark, monkeypatch):
    """Rule lines, of which the vocabulary has pieces of up to 128 bytes, against all segmentations; a count beyond the count bits."""
    import public_tokenizers as P

    ranks = queries.tokenizer_files()[0]
    vocabulary = token_counts.Vocabulary(ranks)
    assert max(map(len, vocabulary.costs)) == 128 and vocabulary.one(b"-" * 64) == 1

    def best(word):
        out = [(0, 0)]
        for d in range(1, len(word) + 1):
            out.append(min((out[a][0] + (c >> 20), out[a][1] + 1) for a in range(d) if (c := vocabulary.costs.get(word[a:d])) is not None))
        return out[-1][1]

    lines = [c * n for c in "-=_.*~# " for n in (49, 64, 80, 127, 128, 129, 200)]
    assert [vocabulary.one(x.encode()) for x in lines] == [best(x.encode()) for x in lines]
    rules = [x for x in lines if x.strip()]
    out = {r["doc_id"]: (r["n_pretokens"], r["n_tokens"]) for r in token_counts.token_counts(spark.createDataFrame(list(enumerate(rules)), "doc_id int, text string"), ranks, P.PATTERN).collect()}
    assert out == {i: (1, best(x.encode())) for i, x in enumerate(rules)}
    monkeypatch.setattr(token_counts, "_COUNT_BITS", 4)
    assert token_counts.Vocabulary(ranks).one(b"\x00\x01" * 40) == vocabulary.one(b"\x00\x01" * 40) > 15


# exact deduplication


def brute_copies(rows):
    groups = collections.defaultdict(list)
    for d, t in rows:
        groups[t].append(d)
    return sorted((d, max(groups[t]), len(groups[t]), d == max(groups[t]), hashlib.sha256(t).hexdigest()) for d, t in rows)


@pytest.mark.parametrize("chunk", [exact_dedup.CHUNK, 4])
def test_exact_dedup(docs, monkeypatch, chunk):
    monkeypatch.setattr(exact_dedup, "CHUNK", chunk)
    assert sorted(map(tuple, exact_dedup.duplicate_groups(docs).collect())) == brute_copies(pairs(docs))
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    want = {d for d, _, _, k, _ in brute_copies(pairs(docs)) if k}
    rows = kept.collect()
    assert {r["doc_id"] for r in rows} == want and len(rows) == len(want)
    assert set(map(str, rows)) <= set(map(str, docs.collect()))


def test_owners_follow_the_rows(docs, monkeypatch):
    """More rows make more calls of owners, not larger ones."""
    want = brute_copies(pairs(docs))
    monkeypatch.setattr(exact_dedup, "OWNER_ROWS", 5)
    assert docs.count() / 5 > exact_dedup.partitions(docs.sparkSession)
    got = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact_dedup.duplicate_groups(docs).collect()]
    assert sorted(got) == sorted(want)


def test_exact_dedup_of_odd_tables(odd, empty):
    assert exact_dedup.duplicate_groups(empty).count() == exact_dedup.keep_one(empty).count() == 0
    out = exact_dedup.duplicate_groups(odd).collect()
    got = collections.Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in out)
    assert got == {(None, None, 1, True): 1, (None, 7, 2, False): 1, (7, 7, 2, True): 1, (5, 6, 4, False): 2, (6, 6, 4, True): 1, (None, 6, 4, False): 1, (5, 5, 1, True): 1}
    assert exact_dedup.keep_one(odd).count() == 4


def test_golomb_codes():
    rng = np.random.default_rng(1)
    for n, bits in ((0, 44), (1, 44), (5, 8), (3000, 40), (3000, 11)):
        values = np.sort(rng.integers(0, 1 << bits, n).astype(np.uint64))
        k, code = exact_dedup.golomb_encode(values, bits)
        assert exact_dedup.golomb_decode(n, k, code).tolist() == values.tolist()
    assert len(code) * 8 < 3000 * 3


# packing


@pytest.mark.parametrize("held", [packing.OPEN_PIECES, 20])
def test_packing_is_a_round_trip(docs, monkeypatch, held):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "OPEN_PIECES", held)
    groups = 1 if held > 20 else 10

    ranks, path = queries.tokenizer_files()
    definition = Tokenizer.from_file(path)
    pieces = packing.pack(docs, ranks, path, size=256).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4")
        assert len(ids) == p["length"]
        by_doc[p["doc_id"]].append((p["start"], ids))
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
        assert p["doc_tokens"] > p["start"]
    for d, t in pairs(docs):
        parts = sorted(by_doc[d], key=lambda x: x[0])
        ids = np.concatenate([x for _, x in parts])
        assert ids.tolist() == definition.encode(t.decode(), add_special_tokens=False).ids + [0]
        assert [s for s, _ in parts] == np.cumsum([0] + [len(x) for _, x in parts])[:-1].tolist()
    fill = []
    for parts in by_sequence.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()
        fill.append(sum(n for _, n in parts))
    assert max(fill) <= 256 and sum(f < 256 for f in fill) <= groups


def test_sum_of_squares_rule():
    p = packing.Packer(10, 0)
    put = lambda s: p.place("d", np.arange(s))
    for s in (6, 6, 3):  # 3 fits on a 6, where two windows stand: that lowers the sum most
        put(s)
    assert p.levels[6] == 1 and p.levels[9] == 1 and p.levels[3] == 0
    assert [x[4:] for x in put(1)] == [(0, 0), (0, 6), (0, 9)] and p.levels[9] == 0


def test_open_windows_of_many_partitions_are_placed_by_the_rule(spark):
    """Few windows are cut: with rests of halves and quarters of a window, none."""
    rng = np.random.default_rng(3)
    rows = [(i, " a" * (int(rng.choice([31, 31, 15])))) for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    pieces = packing.pack(df, *queries.tokenizer_files(), size=64).collect()
    assert sum(p["length"] != p["doc_tokens"] for p in pieces) <= 2
    assert len({p["sequence_id"] for p in pieces}) == -(-sum(p["length"] for p in pieces) // 64)


def test_both_libraries_give_the_same_ids():
    from tokenizers import Tokenizer

    files = queries.tokenizer_files()
    encode, definition = packing.encoder(*files), Tokenizer.from_file(files[1])
    rng = np.random.default_rng(2)
    ranges = [(0, 0x20), (0x20, 0x7F), (0x80, 0x250), (0x300, 0x370), (0x600, 0x700), (0x900, 0x980), (0x2000, 0x2070), (0x3040, 0x30FF), (0x4E00, 0x5000), (0xAC00, 0xAD00), (0xFE00, 0xFF00), (0x1F300, 0x1F700), (0xE0000, 0xE0080)]
    for _ in range(4000):
        parts = [ranges[k] for k in rng.integers(0, len(ranges), rng.integers(1, 5))]
        text = "".join(chr(int(rng.integers(*r))) + " '\n\t"[int(rng.integers(0, 4))] * int(rng.integers(0, 3)) for r in parts for _ in range(int(rng.integers(1, 6))))
        assert encode(text) == definition.encode(text, add_special_tokens=False).ids, ascii(text)


def test_special_tokens_in_text():
    encode = packing.encoder(*queries.tokenizer_files())
    assert encode("a<|endoftext|>") == [64, 50256] and encode("") == []


def test_packing_of_odd_tables(odd, empty):
    files = queries.tokenizer_files()
    assert packing.pack(empty, *files).count() == 0
    assert sum(p["length"] == p["doc_tokens"] == 1 for p in packing.pack(odd, *files).collect()) == 2


# toxicity


def test_toxicity_learns_and_generalises(spark):
    rng = np.random.default_rng(4)
    clean = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(1200):
        w = list(rng.choice(clean, int(rng.integers(3, 60))))
        bad = i % 6 == 0
        if bad:
            w.insert(int(rng.integers(0, len(w))), ["vile", "Rotten", f"nastygram{i}"][i // 6 % 3])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    weights = toxicity.fit(docs, marks, ~toxicity.held_out())
    out = toxicity.score(docs.withColumn("held", toxicity.held_out()), weights).collect()
    held = [r for r in out if r["held"]]
    assert 200 < len(held) < 400 and all(r["held"] == (binascii.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    assert sum((r["_score"] >= 0.3) == (r["doc_id"] % 6 == 0) for r in held) >= 0.97 * len(held)
    assert 0 < np.count_nonzero(weights) < 2_000


def test_ftrl_is_the_plain_recurrence():
    rng = np.random.default_rng(6)
    model, z, n = toxicity.Ftrl(50), collections.defaultdict(float), collections.defaultdict(float)

    def weight(i):
        l1 = 0.0 if i == 50 else toxicity.L1
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(3000):
        at = np.unique(rng.integers(0, 50, rng.integers(0, 9)))
        label = int(rng.random() < (0.9 if 3 in at else 0.1))
        model.learn(at, label)
        used = [*at.tolist(), 50]
        w = {i: weight(i) for i in used}
        g = 1 / (1 + math.exp(-sum(w.values()))) - label
        for i in used:
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / toxicity.ALPHA * w[i]
            n[i] += g * g
    got = model.weights(np.arange(51))
    assert np.allclose(got, [weight(i) for i in range(51)]) and np.count_nonzero(got) > 1 and got[3] == max(got)


def test_toxicity_labels_out_of_bounds_do_not_matter(spark):
    docs = spark.createDataFrame([(i, f"text {i} {'bad' if i % 2 else 'good'}") for i in range(80)], "doc_id long, text string")
    fit = lambda rows: toxicity.fit(docs, spark.createDataFrame(rows, "doc_id long, toxic int"), ~toxicity.held_out())
    held = lambda i: binascii.crc32(str(i).encode()) % 4 == 2
    one = fit([(i, i % 2) for i in range(80)])
    assert np.array_equal(one, fit([(i, (i + held(i)) % 2) for i in range(80)] + [(None, 1), (3, None)]))


def test_toxicity_of_odd_tables(spark, docs, odd, empty):
    labels = spark.createDataFrame([(5, 1), (6, 0)], "doc_id long, toxic int")
    weights = toxicity.fit(odd, labels, F.lit(True))
    assert toxicity.score(odd, weights).count() == 8 and toxicity.score(empty, weights).count() == 0
    scored = toxicity.score(docs, weights)
    assert scored.columns == [c for c in docs.columns if c != "_score"] + ["_score"] and scored.filter("_score between 0 and 1").count() == docs.count()
    nothing = toxicity.fit(empty, spark.createDataFrame([], "doc_id long, toxic int"), F.lit(True))
    assert {r["_score"] for r in toxicity.score(odd, nothing).collect()} == {0.5}
