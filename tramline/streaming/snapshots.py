"""Polled snapshots as a stream: each batch is a whole snapshot and replaces the current table of its endpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.sinks import publish


def follow(spark: SparkSession, path: str, schema: str, current: str, checkpoint: str, valid: Callable[[DataFrame], bool] | None = None, every: str | None = None) -> StreamingQuery:
    """Watches a folder of snapshot files (one JSON array or JSON lines each) and keeps the table `current` up to date.

    One file is one poll. A batch that cannot be read, or for which `valid` is false, leaves the table as it is; an
    empty but successful snapshot replaces it. `every` is the poll interval, such as "600 seconds"; without it what
    is there is read and the query ends.
    """
    files = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", 1).load(path)

    def take(batch: DataFrame, number: int) -> None:
        texts = batch.select(F.from_json("value", f"array<struct<{_colons(schema)}>>").alias("rows"), "value")
        if not texts.filter(F.col("rows").isNotNull()).take(1):
            return
        rows = texts.select(F.inline("rows"))
        if valid is None or valid(rows):
            publish(rows.withColumn("poll", F.lit(number)), current, f"poll-{number}")

    query = files.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (query.trigger(processingTime=every) if every else query.trigger(availableNow=True)).start()


def _colons(schema: str) -> str:
    from ..sources.snapshots import _fields

    return _fields(schema)


def latest(polls: DataFrame, endpoint: str = "endpoint", poll: str = "poll", ok: str = "ok") -> DataFrame:
    """Of a log of polls, the rows of each endpoint's last successful poll; endpoints may stand at different polls."""
    last = polls.filter(F.coalesce(F.col(ok), F.lit(False))).groupBy(endpoint).agg(F.max(poll).alias(poll))
    return polls.join(last, [endpoint, poll])
