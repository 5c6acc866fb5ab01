"""Replayable polling of endpoints: replies are logged before their rows are seen, so a batch that runs again is the same.

A trigger is a poll. The driver notes its number in the log; a task per endpoint asks for the reply, writes it to the
log and reads it from there. After a restart the log answers for polls that had a reply, and no endpoint is asked again.
"""

from __future__ import annotations

import json
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import at, exists, whole
from ..sources.sinks import publish
from ..sources.snapshots import _fields


def _reply(url: str, timeout: float) -> dict:
    """What a poll brought: ok, and the body if it was had and is JSON."""
    try:
        with urllib.request.urlopen(url, timeout=timeout) as reply:
            text = reply.read().decode()
        json.loads(text)
        return {"ok": True, "body": text, "error": None}
    except (OSError, ValueError) as e:
        return {"ok": False, "body": None, "error": f"{type(e).__name__}: {e}"[:500]}


class _Ask(InputPartition):
    def __init__(self, endpoint: str, url: str, poll: int, ask: bool):
        self.endpoint, self.url, self.poll, self.ask = endpoint, url, poll, ask


class _Polls(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.endpoints: dict[str, str] = json.loads(options["endpoints"])
        self.log, self.timeout, self.keep = options["log"].rstrip("/"), float(options.get("timeout", 60)), int(options.get("keep", 100))

    def initialOffset(self) -> dict:
        return {"poll": 0}

    def _noted(self) -> list[int]:
        fs, folder = at(f"{self.log}/polls")
        found = fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        return sorted(int(f.base_name) for f in found if f.base_name.isdigit())

    def latestOffset(self) -> dict:
        """Every call is a new poll; its number is in the log before the engine hears of it."""
        noted = self._noted()
        number = noted[-1] + 1 if noted else 0
        with whole(f"{self.log}/polls/{number:012d}") as out:
            out.write(str(int(time.time())).encode())
        return {"poll": number + 1}

    def partitions(self, start: dict, end: dict) -> list[_Ask]:
        """A task for each endpoint and poll. Of polls that were noted but never run, the last alone is asked."""
        return [_Ask(name, url, n, n == end["poll"] - 1) for n in range(start["poll"], end["poll"]) for name, url in sorted(self.endpoints.items())]

    def read(self, ask: _Ask) -> Iterator[tuple]:
        path = f"{self.log}/replies/{ask.poll:012d}/{urllib.parse.quote(ask.endpoint, safe='')}"
        if not exists(path):
            if not ask.ask:
                return
            reply = {"at": int(time.time())} | _reply(ask.url, self.timeout)
            with whole(path) as out:
                out.write(json.dumps(reply, ensure_ascii=False).encode())
        fs, inner = at(path)
        with fs.open_input_stream(inner) as logged:
            reply = json.loads(logged.read())
        yield (ask.endpoint, ask.poll, reply["at"], reply["ok"], reply["body"], reply["error"])

    def commit(self, end: dict) -> None:
        """Replies of polls that lie far enough back are not needed any more."""
        fs, folder = at(f"{self.log}/replies")
        for f in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
            if f.base_name.isdigit() and int(f.base_name) < end["poll"] - self.keep:
                fs.delete_dir(f.path)
        for n in self._noted()[:-1]:
            if n < end["poll"] - self.keep:
                fs.delete_file(f"{at(f'{self.log}/polls')[1]}/{n:012d}")


class LoggedPolls(DataSource):
    """A stream, format("logged_polls"): options endpoints (JSON, name to URL), log (a folder that driver and executors share), timeout, keep (polls in the log).

    Columns endpoint, poll, last_updated (epoch seconds), ok, body (JSON text), error.
    """

    @classmethod
    def name(cls) -> str:
        return "logged_polls"

    def schema(self) -> str:
        return "endpoint string, poll long, last_updated long, ok boolean, body string, error string"

    def streamReader(self, schema) -> _Polls:
        return _Polls(self.options)


def polls(spark: SparkSession, endpoints: dict[str, str], log: str, **options) -> DataFrame:
    """A stream of replies; each trigger polls every endpoint once, in tasks of their own."""
    spark.dataSource.register(LoggedPolls)
    return spark.readStream.format("logged_polls").options(endpoints=json.dumps(endpoints), log=log, **options).load()


def table_path(current: str, endpoint: str) -> str:
    return f"{current.rstrip('/')}/{urllib.parse.quote(endpoint, safe='')}"


def follow_polls(replies: DataFrame, rows: dict[str, str], current: str, checkpoint: str, every: str | None = None, under: str = "data", valid: Callable[[str, DataFrame], bool] | None = None) -> StreamingQuery:
    """Keeps a published table for each endpoint at the rows of its last good reply, with `ordinal`, `poll` and `last_updated`.

    rows: the columns of each endpoint's rows, as DDL. A poll that failed, or that `valid` refuses, leaves the table as it is; a reply without
    `under` empties it. A version is named by its poll, so a batch that runs again writes it over. Without `every`, polls follow each other at once.
    """

    def take(batch: DataFrame, number: int) -> None:
        last = {r["endpoint"]: r["poll"] for r in batch.filter("ok").groupBy("endpoint").agg(F.max("poll").alias("poll")).collect()}
        for endpoint, poll in last.items():
            if endpoint not in rows:
                continue
            reply = batch.filter((F.col("endpoint") == endpoint) & (F.col("poll") == poll))
            parsed = reply.select("poll", "last_updated", F.from_json("body", f"`{under}` array<struct<{_fields(rows[endpoint])}>>").alias("doc"))
            table = parsed.select("poll", "last_updated", F.posexplode(F.col("doc")[under]).alias("ordinal", "row")).select("row.*", F.col("ordinal").cast("long"), "poll", "last_updated")
            if valid is None or valid(endpoint, table):
                publish(table, table_path(current, endpoint), f"poll-{poll}")

    query = replies.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (query.trigger(processingTime=every) if every else query).start()
