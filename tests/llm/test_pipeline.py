"""The pipeline against plain versions of its stages, each judged on its own input."""

import collections
import os
import zlib

import pytest

import corpus_pipeline
from tramline.llm import queries, toxicity

from .test_operators import brute_components, brute_copies, brute_hits


@pytest.fixture(scope="module")
def folder(spark, docs, texts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    plain = docs.selectExpr("doc_id", "text", "lang", "'s' as source", "cast(length(text) as long) as n_chars")
    extra = [(1000 + i, f"{'idiot scum' if i % 6 == 0 else 'fine day'} number w{i} of {i * 7} texts", "en", "s", 30) for i in range(300)]
    plain.unionByName(spark.createDataFrame(extra, plain.schema)).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1000 + i, 1, int(i % 6 == 0)) for i in range(300)] + [(i, 1, 0) for i in range(len(texts))], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    words = texts[7].split()
    spark.createDataFrame([(1, " ".join(words[2:14]))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, rows = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        out = stage(spark, docs, folder)
        if k < 4:
            assert out.columns == columns
            path = f"{folder}/stage{k}"
            out.write.parquet(path)
            docs = spark.read.parquet(path)
            rows[k] = [(r["doc_id"], (r["text"] or "").encode()) for r in before], {r["doc_id"] for r in docs.collect()}
        else:
            packed = {r["doc_id"] for r in out.collect()}
            assert packed == {r["doc_id"] for r in before}
    before, after = rows[0]
    gone = {d for d, _ in before} - after
    assert gone and all(d >= 1000 and (d - 1000) % 6 == 0 for d in gone) and sum((d - 1000) % 6 == 0 for d in after if d >= 1000) <= 3
    before, after = rows[1]
    assert after == {d for d, _, _, kept, _ in brute_copies(before) if kept} and len(after) < len(before)
    before, after = rows[2]
    assert after == {int(d) for d, _, c in brute_components(before) if d == c} and len(after) < len(before)
    before, after = rows[3]
    item = spark.read.parquet(f"{folder}/benchmark.parquet").first()
    assert after == {int(d) for d, _, h, _ in brute_hits(before, [(1, item["text"].encode())]) if not h} and len(after) < len(before)


def test_run_is_the_stages_one_after_the_other(spark, folder):
    out = corpus_pipeline.run(spark, folder).collect()
    assert out and collections.Counter(r["sequence_id"] for r in out) and all(r["length"] <= 1024 for r in out)
    assert all(len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"] for r in out)


def test_queries_over_a_folder(spark, folder):
    """Contracts that hold for any input."""
    n = spark.read.parquet(f"{folder}/documents.parquet").count()
    for name, query in queries.queries().items():
        if name.startswith(("op11", "op12")):  # rows of other things than documents
            continue
        out = query(spark, folder)
        assert "doc_id" in out.columns, name
        if not name.startswith("op9"):
            assert out.count() == n, name
    tox = queries.op10_toxicity(spark, folder).collect()
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in tox)
    assert {f.name: f.dataType.simpleString() for f in queries.op1_sharding(spark, folder).schema} == {
        "doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"
    }
    assert os.path.isdir(folder) and toxicity.TRAIN_ROWS == 20_000
