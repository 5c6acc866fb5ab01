"""Sharding by a two-pass external shuffle.

Pass one scatters rows over buckets of a set size by a seeded hash. Pass two shuffles each bucket in memory after
Fisher and Yates and writes it. The buckets one after the other are a random order of all rows; shards are equal
runs of it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import packed, partitions, unpacked, written

#: Bytes of text in a bucket, on average.
BUCKET_BYTES = 32 << 20
#: Tasks of the second pass at most, if Spark's own number of shuffle partitions is not larger; a task takes its buckets one after the other.
REDUCERS = 20_000
#: Up to so many buckets, their offsets (16 bytes each) are broadcast.
BROADCAST_BUCKETS = 100_000


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    order = list(range(n))
    draws = np.random.default_rng(seed).random(n)
    for i in range(n - 1, 0, -1):
        j = int(draws[i] * (i + 1))
        order[i], order[j] = order[j], order[i]
    return np.array(order, dtype=np.int64)


def _shuffle(seed: int):
    """Rows come bucket by bucket, in an order that their values decide; each bucket leaves in random order."""

    def emit(held: list[pa.RecordBatch], bucket: int) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        order = fisher_yates(table.num_rows, [seed, bucket])
        table = table.take(pa.array(order)).append_column("_pos", pa.array(np.arange(len(order))))
        yield from table.to_batches(max_chunksize=2_000)

    def shuffle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            buckets = batch.column("_bucket")
            for run in pc.run_end_encode(buckets).values.to_pylist() if batch.num_rows else ():
                ids = np.flatnonzero(buckets.to_numpy(zero_copy_only=False) == run)
                if now is not None and run != now:
                    yield from emit(held, now)
                    held = []
                now = run
                held.append(batch.slice(int(ids[0]), len(ids)))
        if held:
            yield from emit(held, now)

    return shuffle


def shard(docs: DataFrame, shards: int = 16, seed: int = 17, doc_id: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Deals rows to shards in random order; law `rows`: the counts of any two shards differ by one at most.

    Adds _shard (int) and _slot (long, from 0 without gaps in each shard), in place of columns of these names. The order depends
    on the rows, the seed and the number of buckets alone, so a lost task gives the same rows again. A null text or
    doc_id is dealt like any value, equal rows are dealt like others (they share a bucket, and which of them gets
    which slot is all the same), and an empty table gives an empty result. Other columns are carried along.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 1).alias("b")).first()["b"] or 0
    n = max(partitions(spark), math.ceil(total / bucket_bytes))
    scatter = packed(docs).withColumn("_scatter", F.xxhash64(F.lit(seed), F.col("row")[doc_id], F.col("row")[text]))
    scatter = scatter.withColumn("_bucket", F.pmod("_scatter", F.lit(n)).cast("int"))
    tasks = min(n, max(partitions(spark), REDUCERS))
    dealt = scatter.repartitionById(tasks, F.floor(F.col("_bucket").cast("long") * tasks / n).cast("int")).sortWithinPartitions("_bucket", "_scatter", F.col("row")[doc_id])
    schema = T.StructType([*dealt.schema.fields, T.StructField("_pos", T.LongType())])
    rows = written(dealt.mapInArrow(_shuffle(seed), schema).drop("_scatter"), "buckets")
    counts = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = written(counts.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy()).alias("_all")), "offsets")
    at = F.col("_before") + F.col("_pos")
    small, more = F.expr(f"_all div {shards}"), F.expr(f"_all % {shards}")
    wide = more * (small + 1)
    which = F.when(at < wide, F.floor(at / (small + 1))).otherwise(more + F.floor((at - wide) / F.greatest(small, F.lit(1))))
    start = which * small + F.least(which, more)
    rows = rows.join(F.broadcast(counts) if n <= BROADCAST_BUCKETS else counts, "_bucket")
    return unpacked(rows, docs.columns, _shard=which.cast("int"), _slot=(at - start).cast("long"))
