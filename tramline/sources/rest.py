"""A paged REST source: one partition per page."""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader


def fetch(url: str, timeout: float = 60) -> dict | list:
    """One JSON document."""
    with urllib.request.urlopen(url, timeout=timeout) as reply:
        return json.loads(reply.read())


class _Page(InputPartition):
    def __init__(self, number: int):
        self.number = number


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.url = options["url"]
        self.items, self.total = options.get("items", "Items"), options.get("total", "TotalPages")

    def _page(self, number: int) -> dict:
        return fetch(self.url.replace("{page}", str(number)))

    def partitions(self) -> list[_Page]:
        """The first page tells how many there are; without that there is one."""
        if "{page}" not in self.url:
            return [_Page(1)]
        return [_Page(n) for n in range(1, int(self._page(1).get(self.total) or 1) + 1)]

    def read(self, page: _Page) -> Iterator[tuple]:
        for ordinal, item in enumerate(self._page(page.number).get(self.items) or []):
            yield (page.number, ordinal, json.dumps(item, ensure_ascii=False))


class PagedRest(DataSource):
    """format("paged_rest"): options url (with {page} if there are pages), items, total. Columns page, ordinal, item (JSON text)."""

    @classmethod
    def name(cls) -> str:
        return "paged_rest"

    def schema(self) -> str:
        return "page int, ordinal int, item string"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def read_pages(spark: SparkSession, url: str, items: str = "Items", total: str = "TotalPages"):
    """Items of all pages as JSON text; parse them with from_json or parse_json."""
    spark.dataSource.register(PagedRest)
    return spark.read.format("paged_rest").options(url=url, items=items, total=total).load()


class _Poll(SimpleDataSourceStreamReader):
    """Each batch is one poll. A reply that can't be had is a row without a body, so the current table stays."""

    def __init__(self, options: dict):
        self.endpoint, self.url = options.get("endpoint", options["url"]), options["url"]
        self.held: dict[int, tuple] = {}

    def initialOffset(self) -> dict:
        return {"poll": 0}

    def _poll(self, number: int) -> tuple:
        try:
            body = json.dumps(fetch(self.url), ensure_ascii=False)
        except (OSError, ValueError):
            body = None
        return (self.endpoint, number, int(time.time()), body)

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        number = start["poll"]
        self.held = {number: self._poll(number)}
        return iter(self.held.values()), {"poll": number + 1}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        """After a restart: what is still held, or else the endpoint as it is now, for the last of these polls."""
        last = end["poll"] - 1
        return iter([self.held.get(last) or self._poll(last)] if end["poll"] > start["poll"] else [])

    def commit(self, end: dict) -> None:
        self.held = {}


class PolledRest(DataSource):
    """A stream, format("polled_rest"): options url and endpoint (its name). Columns endpoint, poll, last_updated (epoch seconds), body (JSON text)."""

    @classmethod
    def name(cls) -> str:
        return "polled_rest"

    def schema(self) -> str:
        return "endpoint string, poll long, last_updated long, body string"

    def simpleStreamReader(self, schema) -> _Poll:
        return _Poll(self.options)


def poll(spark: SparkSession, url: str, endpoint: str | None = None):
    """A stream that polls an endpoint once in a batch; the trigger's interval is the polling interval."""
    spark.dataSource.register(PolledRest)
    return spark.readStream.format("polled_rest").options(url=url, endpoint=endpoint or url).load()
