"""The registered queries of these operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_trie, decontamination, exact_dedup, filter_audit, jaccard_join, lm_scoring, packing, secret_scan, sharding, span_dedup, suffix_dedup, token_counts, toxicity
from .shared import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard(_table(spark, sf_dir, "documents").select("doc_id", "text"), shards=16)
    return rows.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_documents(_table(spark, sf_dir, "documents"), n=5, percent=75)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), length=400)
    size = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return cut.select("doc_id", "n_bytes", size.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup.remove_spans(_table(spark, sf_dir, "documents"), by_content=True)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    counted = lm_scoring.words(docs)
    return lm_scoring.score(docs, lm_scoring.train(docs, counted=counted), counted=counted)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(_table(spark, sf_dir, "documents"), tokenizer_files()[0], public_tokenizers.PATTERN)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.scan(docs, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.col("_n_hit").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        (F.col("_n_hit") > 0).alias("contaminated"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = toxicity.fit(docs, _table(spark, sf_dir, "labels"), ~toxicity.held_out())
    scored = toxicity.score(docs, weights)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.3).cast("int").alias("predicted"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(_table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), *tokenizer_files(), size=1024, end=0)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = conversation_trie.rebuilt(_table(spark, sf_dir, "conversations"))
    return conversation_trie.prefix_trie(written(paths, "paths"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("_spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", *map(count, secret_scan.KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("_spans")).alias("spans"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sharding": op1_sharding,
        "op2_jaccard_join": op2_jaccard_join,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op4_span_dedup": op4_span_dedup,
        "op5_lm_scoring": op5_lm_scoring,
        "op7_token_counts": op7_token_counts,
        "op6_decontamination": op6_decontamination,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_packing": op9_packing,
        "op10_toxicity": op10_toxicity,
        "op11_filter_audit": op11_filter_audit,
        "op12_conversation_trie": op12_conversation_trie,
        "op13_secret_scan": op13_secret_scan,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_decontamination": r"""
            WITH words AS (
                SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w FROM documents),
            items AS (
                SELECT item_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w FROM benchmark),
            test AS (
                SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
                FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
            hits AS (
                SELECT doc_id, i, n, item_id FROM
                (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g FROM
                    (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, (SELECT DISTINCT n FROM test) WHERE len(w) >= n))
                JOIN test USING (n, g)),
            covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
            found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY 1)
            SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
                   sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
            FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)""",
        "op8_exact_dedup": """
            WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
            SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
                   doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
            FROM d""",
        "op11_filter_audit": r"""
            WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
            w AS (SELECT *, [x FOR x IN string_split_regex(t, '[\x20\x09-\x0D]+') IF x <> ''] AS w, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
            l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
            fails AS (SELECT part, doc_id, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                {'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w), 'C': 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * len(t),
                 'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(doc_id > least, false)} AS f FROM w LEFT JOIN l USING (doc_id)),
            docs AS (SELECT part, doc_id, good, toxic, CASE WHEN f.A THEN 'A' ELSE '' END || CASE WHEN f.B THEN 'B' ELSE '' END || CASE WHEN f.C THEN 'C' ELSE '' END || CASE WHEN f.D THEN 'D' ELSE '' END || CASE WHEN f.E THEN 'E' ELSE '' END AS m FROM fails),
            masks AS (SELECT part, m, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM docs GROUP BY 1, 2),
            letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
            orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letter a, letter b, letter c, letter d, letter e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
            steps AS (SELECT o AS filter_order, k::INT AS step, o[k] AS own, o[1 : k - 1] AS before FROM orders, (SELECT unnest(range(1, 6)) AS k)),
            tagged AS (SELECT *, contains(m, own) AS fail, len([x FOR x IN string_split(m, '') IF x <> '' AND contains(before, x)]) > 0 AS gone FROM masks, steps),
            sums AS (SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (WHERE NOT fail AND NOT gone), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (WHERE fail AND NOT gone), 0)::BIGINT AS removed,
                coalesce(sum(n) FILTER (WHERE fail AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (WHERE m = own), 0)::BIGINT AS unique_fails,
                coalesce(sum(good) FILTER (WHERE fail AND NOT gone), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (WHERE fail AND NOT gone), 0)::BIGINT AS toxic_lost FROM tagged GROUP BY 1, 2, 3, 4)
            SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM sums""",
        "op12_conversation_trie": r"""
            WITH own AS (SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS p FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
            crc AS (SELECT c, p, xor(list_reduce([4294967295::BIGINT] || [unicode(x)::BIGINT FOR x IN string_split(c::VARCHAR, '')],
                lambda a, b: list_reduce([xor(a, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 4 AS h FROM own),
            built AS (SELECT a.c, coalesce(b.p[1 : a.h], []) || a.p[a.h + 1 :] AS p FROM crc a LEFT JOIN own b ON b.c = a.c - a.c % 20),
            members AS (SELECT c, unnest(range(0, len(p) + 1)) AS d, p FROM built),
            keyed AS (SELECT c, d, len(p) AS n, p[1 : d] AS k, CASE WHEN d > 0 THEN p[1 : d - 1] END AS up, CASE WHEN d > 0 THEN len([x FOR x IN string_split_regex(p[d].t, '[\x20\x09-\x0D]+') IF x <> '']) ELSE 0 END AS w FROM members),
            nodes AS (SELECT d, k, any_value(up) AS up, min(c) AS conv_id, count(*) AS n_convs, max(w) AS w, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '') AS ids FROM keyed GROUP BY 1, 2),
            kids AS (SELECT up, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
            full_nodes AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids ON kids.up = nodes.k),
            above AS (SELECT k[1 : a] AS k, CASE WHEN n_children = 0 THEN 1 ELSE 0 END AS leaf, (n_convs - 1) * w AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM full_nodes)),
            sums AS (SELECT k, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM above GROUP BY 1)
            SELECT x.conv_id, x.d::BIGINT AS depth, p.conv_id AS parent_conv_id, x.n_convs::BIGINT AS n_convs, x.n_children::BIGINT AS n_children, n_leaves, saved_tokens, sha256(x.ids) AS ends_sha256
            FROM full_nodes x JOIN sums ON sums.k = x.k LEFT JOIN nodes p ON x.d > 0 AND p.k = x.up""",
    }
