"""Catalogues of feeds and inputs, and the decisions of when to fetch and when to build."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.semantics import is_older

FEED = "feed_id string, type string, source string, file_pattern string"
UPDATER = "type string, source_type string, feed_id string, url string"


def feeds(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Timetable feeds. Keys as in the configuration: feedId, type (netex or gtfs), source, groupFilePattern."""
    return spark.createDataFrame([(r.get("feedId"), r.get("type"), r.get("source"), r.get("groupFilePattern")) for r in rows], FEED)


def updaters(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Realtime sources. Keys as in the configuration: type, sourceType, feedId, url."""
    return spark.createDataFrame([(r.get("type"), r.get("sourceType"), r.get("feedId"), r.get("url")) for r in rows], UPDATER)


def is_remote(source: Column) -> Column:
    return source.rlike("^https?://")


def to_fetch(inputs: DataFrame, files: DataFrame) -> DataFrame:
    """Inputs (name) with `action`: `download` where no file is there, else `update`."""
    return inputs.join(files.select("name", F.lit(True).alias("_there")), "name", "left").withColumn("action", F.when(F.col("_there"), "update").otherwise("download")).drop("_there")


def to_derive(pairs: DataFrame) -> DataFrame:
    """Pairs of modification times (source_time, derived_time) where the derived file is missing or older."""
    return pairs.filter(F.col("derived_time").isNull() | (F.col("source_time") > F.col("derived_time")))


def stale(files: DataFrame, now: int, days: int = 3) -> DataFrame:
    """Files whose `modified` (epoch seconds) is more than so many days back."""
    return files.filter(is_older(F.col("modified"), F.lit(now), days * 86_400))


def dated_url(template: str, day: Column) -> Column:
    """A URL with {date} as yyyyMMdd."""
    head, _, tail = template.partition("{date}")
    return F.concat(F.lit(head), F.date_format(day, "yyyyMMdd"), F.lit(tail))
