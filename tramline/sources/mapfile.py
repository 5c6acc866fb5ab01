"""Map extracts in blobs: a task takes the blobs that begin in its range of bytes and finds the first of them by itself."""

from __future__ import annotations

import json
import lzma
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .files import at
from .wire import fields, packed, signed, two, zigzag

#: Bytes of a file in a partition.
SPLIT = 64 << 20
# Fixed values of the format: kinds of members by number, the types of blobs, sizes that no header or blob exceeds.
MEMBERS = ("node", "way", "relation")
HEADER, DATA = b"OSMHeader", b"OSMData"
MOST_HEADER, MOST_BLOB = 64 << 10, 32 << 20
KNOWN = ("OsmSchema-V0.6", "DenseNodes", "HistoricalInformation")

_REF = pa.struct([("kind", pa.string()), ("id", pa.int64()), ("role", pa.string())])
_SCHEMA = pa.schema([("kind", pa.string()), ("id", pa.int64()), ("lat", pa.float64()), ("lon", pa.float64()), ("tags", pa.map_(pa.string(), pa.string())), ("refs", pa.list_(_REF))])


class BadExtract(ValueError):
    """The file is not what it should be."""


def _header(data: bytes) -> tuple[bytes, int] | None:
    """Type and size of a blob, if these bytes are a blob's header."""
    try:
        found = dict(fields(data))
    except (ValueError, IndexError):
        return None
    kind, size = found.get(1), found.get(3)
    return (kind, size) if kind in (HEADER, DATA) and isinstance(size, int) and 0 <= size <= MOST_BLOB else None


def _blob_at(f, place: int, size: int) -> tuple[bytes, int, int] | None:
    """(type, first byte of the blob, byte after it), if a blob begins at a place."""
    f.seek(place)
    head = f.read(4)
    length = int.from_bytes(head, "big")
    if len(head) < 4 or not 0 < length <= MOST_HEADER:
        return None
    found = _header(f.read(length))
    first = place + 4 + length
    return (found[0], first, first + found[1]) if found and first + found[1] <= size else None


def first_blob(f, start: int, size: int) -> int | None:
    """The place of the first blob at or after `start`: one that is followed by another, or by the end of the file."""
    for kind in (DATA, HEADER):
        if start == 0:
            return 0
        mark, place, step = b"\x0a" + bytes([len(kind)]) + kind, start, 1 << 20
        while place < size:
            f.seek(place)
            window = f.read(step + len(mark) + 4)
            k = window.find(mark, 4)
            while 4 <= k < step + 4:
                found = _blob_at(f, place + k - 4, size)
                if found and (found[2] == size or _blob_at(f, found[2], size)):
                    return place + k - 4
                k = window.find(mark, k + 1)
            place += step
    return None


def _content(blob: bytes) -> bytes:
    found = dict(fields(blob))
    if 1 in found:
        return found[1]
    if 3 in found:
        return zlib.decompress(found[3])
    if 4 in found:
        return lzma.decompress(found[4])
    if 7 in found:
        return zstandard.ZstdDecompressor().decompress(found[7], found.get(2, 0))
    raise BadExtract("a blob is packed in an unknown way")


def _check(data: bytes) -> None:
    """Refuses files that need what is not known here."""
    unknown = [v.decode() for n, v in fields(data) if n == 4 and v.decode() not in KNOWN]
    if unknown:
        raise BadExtract(f"the file needs {', '.join(unknown)}")


class _Block:
    """A block of elements: its texts, and how its numbers become degrees."""

    def __init__(self, data: bytes):
        self.texts, self.groups, grain, lat, lon = [], [], 100, 0, 0
        for n, v in fields(data):
            if n == 1:
                self.texts = [t.decode() for k, t in fields(v) if k == 1]
            elif n == 2:
                self.groups.append(v)
            elif n == 17:
                grain = v
            elif n == 19:
                lat = two(v)
            elif n == 20:
                lon = two(v)
        self.degrees = lambda values, which: (((lat, lon)[which]) + grain * values) / 1e9

    def tags(self, keys: bytes, values: bytes) -> list[tuple[str, str]]:
        return [(self.texts[int(k)], self.texts[int(v)]) for k, v in zip(packed(keys), packed(values))]

    def elements(self, wanted: set[str]) -> Iterator[tuple]:
        for group in self.groups:
            for n, v in fields(group):
                if n == 2 and "node" in wanted:
                    yield from self._dense(v)
                elif n == 1 and "node" in wanted:
                    one = dict(fields(v))
                    lat, lon = (float(self.degrees(zigzag(one.get(k, 0)), k - 8)) for k in (8, 9))
                    yield ("node", zigzag(one[1]), lat, lon, self.tags(one.get(2, b""), one.get(3, b"")), [])
                elif n == 3 and "way" in wanted:
                    one = dict(fields(v))
                    ids = np.cumsum(signed(packed(one.get(8, b""))))
                    yield ("way", two(one[1]), None, None, self.tags(one.get(2, b""), one.get(3, b"")), [("node", int(i), "") for i in ids])
                elif n == 4 and "relation" in wanted:
                    one = dict(fields(v))
                    ids, roles, kinds = np.cumsum(signed(packed(one.get(9, b"")))), packed(one.get(8, b"")), packed(one.get(10, b""))
                    yield ("relation", two(one[1]), None, None, self.tags(one.get(2, b""), one.get(3, b"")), [(MEMBERS[int(k)], int(i), self.texts[int(r)]) for i, r, k in zip(ids, roles, kinds)])

    def _dense(self, data: bytes) -> Iterator[tuple]:
        """Nodes as columns of differences; their tags are pairs of texts, with a 0 after each node's."""
        one = dict(fields(data))
        ids, lats, lons = (np.cumsum(signed(packed(one.get(k, b"")))) for k in (1, 8, 9))
        pairs, at = packed(one.get(10, b"")).tolist(), 0
        for i, lat, lon in zip(ids.tolist(), self.degrees(lats, 0).tolist(), self.degrees(lons, 1).tolist()):
            tags = []
            while at < len(pairs) and pairs[at]:
                tags.append((self.texts[pairs[at]], self.texts[pairs[at + 1]]))
                at += 2
            at += 1
            yield ("node", i, lat, lon, tags, [])


class _Range(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths, self.split, self.wanted = json.loads(options["paths"]), int(options.get("split", SPLIT)), set(json.loads(options.get("kinds", "null")) or MEMBERS)

    def partitions(self) -> list[_Range]:
        out = []
        for path in self.paths:
            fs, inner = at(path)
            size = fs.get_file_info(inner).size
            if size is None:
                raise FileNotFoundError(path)
            out += [_Range(path, start, min(start + self.split, size)) for start in range(0, size, self.split)]
        return out or [_Range("", 0, 0)]

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        fs, inner = at(part.path)
        size = fs.get_file_info(inner).size
        with fs.open_input_file(inner) as f:
            place = first_blob(f, part.start, size)
            while place is not None and place < part.end:
                found = _blob_at(f, place, size)
                if found is None:
                    raise BadExtract(f"no blob at byte {place} of {part.path}")
                kind, first, place = found
                f.seek(first)
                data = _content(f.read(place - first))
                if kind == HEADER:
                    _check(data)
                else:
                    rows = list(_Block(data).elements(self.wanted))
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*[(*r[:5], [dict(zip(("kind", "id", "role"), x)) for x in r[5]]) for r in rows]), _SCHEMA)], schema=_SCHEMA)
                if place >= size:
                    break


class MapExtract(DataSource):
    """format("map_extract"): options paths (JSON list), split (bytes of a partition), kinds (JSON list, all if it isn't given). Elements as in plans/elements.py."""

    @classmethod
    def name(cls) -> str:
        return "map_extract"

    def schema(self) -> str:
        return "kind string, id long, lat double, lon double, tags map<string,string>, refs array<struct<kind:string,id:long,role:string>>"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def read_extract(spark: SparkSession, paths: str | list[str], split: int = SPLIT, kinds: list[str] | None = None) -> DataFrame:
    """Elements of map extracts, of some kinds if they are given; others are not decoded. A partition is a range of bytes, wherever its blobs begin.

    Conditions stay with Spark: a filter that a Python reader takes holds for every later use of the same DataFrame, too, so rows would be lacking there.
    """
    spark.dataSource.register(MapExtract)
    options = {"paths": json.dumps([paths] if isinstance(paths, str) else paths), "split": split} | ({"kinds": json.dumps(kinds)} if kinds else {})
    return spark.read.format("map_extract").options(**options).load()
