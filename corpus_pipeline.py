"""The corpus pipeline: from raw documents to packed sequences.

STAGES holds (name, function of (spark, docs, sf_dir)). Each stage gets what the one before it kept; all but the last
return the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm import decontamination, exact_dedup, jaccard_join, packing, toxicity
from tramline.llm.queries import tokenizer_files
from tramline.llm.shared import written

#: Documents with this score or more are rejected.
TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the classifier calls toxic. It learns from the labels of documents that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    weights = toxicity.fit(docs, labels, ~toxicity.held_out())
    return toxicity.score(docs, weights).filter(F.col("_score") < TOXIC).drop("_score")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, keeps the row with the largest doc_id."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.75 or more, keeps that with the least doc_id."""
    return jaccard_join.keep_one(docs, n=5, percent=75)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in which a window of ten words of a benchmark item occurs."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n=10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 1024 tokens: a row per piece, with its ids (unsigned 32-bit, little endian)."""
    pieces = packing.pack(docs, *tokenizer_files(), size=1024, end=0)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack),
]

#: A trained classifier and a tokenizer are beyond SQL; the tests compare run() with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each one written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
