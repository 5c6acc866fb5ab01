"""Collections of one posted query: the reply is staged once and read as a table for each collection."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .files import scratch
from .snapshots import _fields


class ReplyError(RuntimeError):
    """The service answered, but not with data."""


def post(url: str, query: str, variables: dict | None = None, timeout: float = 600) -> dict:
    """The data of a reply. A reply with errors, or without data, is an error."""
    body = json.dumps({"query": query} | ({"variables": variables} if variables else {})).encode()
    request = urllib.request.Request(url, body, {"Content-Type": "application/json", "Accept": "application/json"}, method="POST")
    with urllib.request.urlopen(request, timeout=timeout) as reply:
        document = json.loads(reply.read())
    if not isinstance(document, dict) or document.get("errors") or not isinstance(document.get("data"), dict):
        raise ReplyError(f"{url}: {json.dumps((document if isinstance(document, dict) else {}).get('errors'), ensure_ascii=False)[:500]}")
    return document["data"]


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.query, self.variables = options["url"], options["query"], json.loads(options.get("variables", "null"))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, _: InputPartition) -> Iterator[tuple]:
        for name, rows in post(self.url, self.query, self.variables).items():
            for ordinal, row in enumerate(rows if isinstance(rows, list) else [] if rows is None else [rows]):
                yield (name, ordinal, json.dumps(row, ensure_ascii=False))


class PostedQuery(DataSource):
    """format("posted_query"): options url, query, variables (JSON). One request a scan. Columns collection, ordinal, item (JSON text)."""

    @classmethod
    def name(cls) -> str:
        return "posted_query"

    def schema(self) -> str:
        return "collection string, ordinal long, item string"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def read_posted(spark: SparkSession, url: str, query: str, rows: dict[str, str], variables: dict | None = None, staging: str | None = None) -> dict[str, DataFrame]:
    """Posts a query once, stages its reply below `staging` (or the shared scratch folder), and gives a table per collection.

    rows: the columns of each collection's rows, as DDL; `ordinal` is added. A collection that the reply has not, or has as null, is an
    empty table; a single object is one row. A reply with errors raises and stages nothing that could be read.
    """
    spark.dataSource.register(PostedQuery)
    path = f"{staging.rstrip('/')}/reply" if staging else scratch(spark, "reply")
    asked = spark.read.format("posted_query").options(url=url, query=query, variables=json.dumps(variables)).load()
    asked.write.mode("overwrite").partitionBy("collection").parquet(path)
    staged = spark.read.schema("ordinal long, item string, collection string").parquet(path)
    return {name: staged.filter(F.col("collection") == name).select("ordinal", F.from_json("item", f"struct<{_fields(kind)}>").alias("row")).select("row.*", "ordinal") for name, kind in rows.items()}
