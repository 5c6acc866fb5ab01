"""Vector tiles of a service as rows: a partition per tile of a box at a zoom level."""

from __future__ import annotations

import gzip
import math
import urllib.error
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .wire import fields, packed, real, two, zigzag

# Fixed values of the format: kinds of geometry, commands of a geometry, the largest latitude of the square map.
GEOMETRIES = ("Unknown", "Point", "LineString", "Polygon")
MOVE, LINE, CLOSE = 1, 2, 7
TOP = 85.0511287798066


def tile_of(lon: float, lat: float, zoom: int) -> tuple[int, int]:
    """Column and row of the tile that holds a place."""
    n = 1 << zoom
    y = (1 - math.asinh(math.tan(math.radians(max(-TOP, min(TOP, lat))))) / math.pi) / 2
    return min(n - 1, max(0, math.floor((lon + 180) / 360 * n))), min(n - 1, max(0, math.floor(y * n)))


def tiles_of(box: tuple[float, float, float, float], zoom: int) -> list[tuple[int, int]]:
    """All tiles of a box minx, miny, maxx, maxy; one that goes over the 180th meridian has minx > maxx."""
    x0, y0, x1, y1 = box
    if x0 > x1:
        return list(dict.fromkeys(tiles_of((x0, y0, 180, y1), zoom) + tiles_of((-180, y0, x1, y1), zoom)))
    (left, low), (right, high) = tile_of(x0, y0, zoom), tile_of(x1, y1, zoom)
    return [(x, y) for x in range(left, right + 1) for y in range(high, low + 1)]


def _value(data: bytes) -> str:
    """A tag's value as text; booleans and numbers as in JSON."""
    for n, v in fields(data):
        if n == 1:
            return v.decode()
        if n in (2, 3):
            x = real(v)
            return str(int(x)) if x.is_integer() and abs(x) < 2**53 else repr(x)
        return str({4: two, 5: int, 6: zigzag}[n](v)) if n != 7 else "true" if v else "false"
    return ""


def lines(commands: list[int]) -> list[list[tuple[int, int]]]:
    """The parts of a geometry, in units of the tile: its points, lines, or rings (which end where they began)."""
    out, x, y, at = [], 0, 0, 0
    while at < len(commands):
        what, count = commands[at] & 7, commands[at] >> 3
        at += 1
        if what == CLOSE:
            out[-1].append(out[-1][0])
            continue
        if what not in (MOVE, LINE):
            raise ValueError(f"unknown command {what}")
        for _ in range(count):
            x, y = x + zigzag(commands[at]), y + zigzag(commands[at + 1])
            at += 2
            if what == MOVE:
                out.append([])
            out[-1].append((x, y))
    return out


def features(data: bytes, zoom: int, column: int, row: int) -> Iterator[tuple]:
    """(layer, id, geometry, tags, parts) of a tile, parts in degrees."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    n = 1 << zoom
    for k, layer in fields(data):
        if k != 3:
            continue
        name, keys, values, found, extent = "", [], [], [], 4096
        for f, v in fields(layer):
            if f == 1:
                name = v.decode()
            elif f == 2:
                found.append(v)
            elif f == 3:
                keys.append(v.decode())
            elif f == 4:
                values.append(_value(v))
            elif f == 5:
                extent = v

        def degrees(p: tuple[int, int]) -> dict:
            x, y = (column + p[0] / extent) / n, (row + p[1] / extent) / n
            return {"lon": x * 360 - 180, "lat": math.degrees(math.atan(math.sinh(math.pi * (1 - 2 * y))))}

        for feature in found:
            one = dict(fields(feature))
            pairs = packed(one.get(2, b"")).tolist()
            tags = {keys[a]: values[b] for a, b in zip(pairs[::2], pairs[1::2])}
            parts = lines(packed(one.get(4, b"")).tolist())
            yield name, one.get(1), GEOMETRIES[one.get(3, 0)], tags, [[degrees(p) for p in part] for part in parts]


class _Tile(InputPartition):
    def __init__(self, x: int, y: int):
        self.x, self.y = x, y


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.zoom = options["url"], int(options["zoom"])
        self.box = tuple(map(float, options["box"].split(",")))

    def partitions(self) -> list[_Tile]:
        return [_Tile(x, y) for x, y in tiles_of(self.box, self.zoom)]

    def read(self, tile: _Tile) -> Iterator[tuple]:
        url = self.url.replace("{z}", str(self.zoom)).replace("{x}", str(tile.x)).replace("{y}", str(tile.y))
        try:
            with urllib.request.urlopen(url, timeout=60) as reply:
                data = reply.read()
        except urllib.error.HTTPError as e:
            if e.code in (204, 404):  # a tile without anything in it
                return
            raise
        for ordinal, found in enumerate(features(data, self.zoom, tile.x, tile.y)):
            yield (self.zoom, tile.x, tile.y, ordinal, *found)


class VectorTiles(DataSource):
    """format("vector_tiles"): options url (with {z}, {x}, {y}), zoom, box (minx,miny,maxx,maxy).

    Columns z, x, y, ordinal, layer, id, geometry (its kind), tags, parts (of points in degrees). A feature comes once for each tile that shows a piece of it.
    """

    @classmethod
    def name(cls) -> str:
        return "vector_tiles"

    def schema(self) -> str:
        return "z int, x int, y int, ordinal long, layer string, id long, geometry string, tags map<string,string>, parts array<array<struct<lon:double,lat:double>>>"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def read_tiles(spark: SparkSession, url: str, zoom: int, box: str) -> DataFrame:
    """Features of all tiles of a box."""
    spark.dataSource.register(VectorTiles)
    return spark.read.format("vector_tiles").options(url=url, zoom=zoom, box=box).load()
