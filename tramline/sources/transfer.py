"""Transfer of many feeds, a task each, by a manifest of what was had before."""

from __future__ import annotations

import http.client
import time
import urllib.error
import urllib.request
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .files import exists, whole
from .sinks import publish, published

BLOCK = 1 << 20
MANIFEST = "name string, url string, file string, etag string, modified string, bytes long, action string, error string, at long"


class Cut(OSError):
    """A transfer that ended before its file did."""


def _blocks(reply) -> Iterator[bytes]:
    want, had = reply.headers.get("Content-Length"), 0
    while block := reply.read(BLOCK):
        had += len(block)
        yield block
    if want is not None and had != int(want):
        raise Cut(f"{had} of {want} bytes")


def _unpacked(blocks: Iterator[bytes]) -> Iterator[bytes]:
    """The content of gzip members, one after the other."""
    one, begun = zlib.decompressobj(31), False
    for block in blocks:
        while block:
            if one.eof:
                one = zlib.decompressobj(31)
            out, begun = one.decompress(block), True
            if out:
                yield out
            block = one.unused_data if one.eof else b""
    if not begun or not one.eof:
        raise Cut("the compressed file ends early")


def _had(row: dict, timeout: float) -> dict:
    """Fetches one feed if it changed. Its file gets its name when all of it is there."""
    known = row["file"] == row["target"] and row["url_before"] == row["url"] and exists(row["target"])
    headers = {k: v for k, v in (("If-None-Match", row["etag"]), ("If-Modified-Since", row["modified"])) if v and known}
    try:
        with urllib.request.urlopen(urllib.request.Request(row["url"], headers=headers), timeout=timeout) as reply:
            size, blocks = 0, _blocks(reply)
            blocks = _unpacked(blocks) if row["gunzip"] else blocks
            with whole(row["target"]) as out:
                if row["member"]:
                    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z, z.open(row["member"], "w", force_zip64=True) as inner:
                        for block in blocks:
                            size += inner.write(block)
                else:
                    for block in blocks:
                        size += out.write(block)
            return {"file": row["target"], "etag": reply.headers.get("ETag"), "modified": reply.headers.get("Last-Modified"), "bytes": size, "action": "downloaded", "error": None}
    except urllib.error.HTTPError as e:
        if e.code == 304:
            return {"action": "unchanged", "error": None}
        return {"action": "failed", "error": f"HTTP {e.code}"}
    except (OSError, http.client.HTTPException, zlib.error) as e:
        return {"action": "failed", "error": f"{type(e).__name__}: {e}"[:500]}


def _move(timeout: float, tries: int, delay: float):
    names = [c.split()[0] for c in MANIFEST.split(", ")]
    kinds = pa.schema([(n, pa.int64() if n in ("bytes", "at") else pa.string()) for n in names])

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for k in range(tries):
                    out = row | _had(row, timeout) | {"at": int(time.time())}
                    if out["action"] != "failed" or k == tries - 1 or (out["error"] or "").startswith("HTTP 4"):
                        break
                    time.sleep(delay)
                yield pa.RecordBatch.from_pydict({n: [out[n]] for n in names}, schema=kinds)

    return move


def transfer(feeds: DataFrame, folder: str, manifest: str, timeout: float = 600, tries: int = 3, delay: float = 5) -> DataFrame:
    """Brings the files of feeds up to date and publishes the new manifest at `manifest`; returns it.

    feeds: name, url, target (a file name in `folder`), gunzip (boolean: unpack while it comes), member (if not null, it becomes a zip archive
    with this member). Entity tags and dates of the manifest go with the request, if the file is there. A file that
    comes in part, or not at all, leaves the old one and its entry, with `action` failed and the error; feeds that are not asked for keep their entries.
    """
    spark = feeds.sparkSession
    before = published(spark, manifest) if exists(f"{manifest}/CURRENT") else spark.createDataFrame([], MANIFEST)
    old = before.select("name", F.col("url").alias("url_before"), "file", "etag", "modified", "bytes")
    place = F.concat(F.lit(folder.rstrip("/") + "/"), "target")
    asked = feeds.select("name", "url", place.alias("target"), F.coalesce("gunzip", F.lit(False)).alias("gunzip"), "member").join(F.broadcast(old), "name", "left")
    tasks = max(1, min(feeds.count(), 10_000))
    now = asked.repartition(tasks).mapInArrow(_move(timeout, tries, delay), MANIFEST)
    publish(now.unionByName(before.join(feeds.select("name"), "name", "left_anti").select(now.columns)), manifest)
    return published(spark, manifest)
