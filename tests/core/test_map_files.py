"""Map extracts and vector tiles: generated files come back element by element."""

import collections
import gzip
import lzma
import math
import random
import struct
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from tramline.functions import display as D
from tramline.plans import elements
from tramline.sources import mapfile, tiles, wire

from .serving import serving

# the wire format, written


def number(v):
    v &= (1 << 64) - 1
    out = bytearray()
    while v > 127:
        out.append(v & 127 | 128)
        v >>= 7
    return bytes(out + bytes([v]))


def zig(v):
    return v << 1 if v >= 0 else (-v << 1) - 1


def field(n, v):
    return number(n << 3 | 2) + number(len(v)) + v if isinstance(v, bytes) else number(n << 3) + number(v)


def packed(values):
    return b"".join(map(number, values))


def deltas(values):
    return packed(zig(b - a) for a, b in zip([0, *values], values))


def test_numbers():
    rng = random.Random(1)
    values = [rng.randrange(1 << rng.randrange(1, 64)) for _ in range(500)] + [0, 127, 128, (1 << 64) - 1]
    assert wire.packed(packed(values)).tolist() == values and wire.packed(b"").tolist() == []
    signed = [rng.randrange(-(1 << 62), 1 << 62) for _ in range(200)] + [0, -1]
    assert wire.signed(wire.packed(packed(map(zig, signed)))).tolist() == signed and [wire.zigzag(zig(v)) for v in signed] == signed
    assert list(wire.fields(field(1, b"x") + field(300, 7) + number(4 << 3 | 1) + struct.pack("<d", 1.5))) == [(1, b"x"), (300, 7), (4, struct.pack("<d", 1.5))]
    for bad in (field(1, b"xyz")[:-1], number(1 << 3 | 3)):
        with pytest.raises(ValueError):
            list(wire.fields(bad))
    with pytest.raises(ValueError):
        wire.packed(b"\x80")


# map extracts


def block(rows, dense, grain=100, offset=(0, 0)):
    texts = [""]
    place = {"": 0}

    def text(t):
        if t not in place:
            place[t] = len(texts)
            texts.append(t)
        return place[t]

    unit = lambda v, o: round((v * 1e9 - o) / grain)
    tags = lambda t: field(2, packed(text(k) for k in t)) + field(3, packed(text(v) for v in t.values())) if t else b""
    groups, nodes = [], [r for r in rows if r[0] == "node"]
    if dense and nodes:
        pairs = [x for r in nodes for x in ([y for k, v in r[4].items() for y in (text(k), text(v))] + [0])]
        groups.append(field(2, field(1, deltas([r[1] for r in nodes])) + field(8, deltas([unit(r[2], offset[0]) for r in nodes])) + field(9, deltas([unit(r[3], offset[1]) for r in nodes])) + (field(10, packed(pairs)) if any(r[4] for r in nodes) else b"")))
    elif nodes:
        groups.append(b"".join(field(1, field(1, zig(r[1])) + tags(r[4]) + field(8, zig(unit(r[2], offset[0]))) + field(9, zig(unit(r[3], offset[1])))) for r in nodes))
    for r in rows:
        if r[0] == "way":
            groups.append(field(3, field(1, r[1]) + tags(r[4]) + field(4, b"") + field(8, deltas([i for _, i, _ in r[5]]))))
        if r[0] == "relation":
            groups.append(field(4, field(1, r[1]) + tags(r[4]) + field(8, packed(text(x) for _, _, x in r[5])) + field(9, deltas([i for _, i, _ in r[5]])) + field(10, packed(mapfile.MEMBERS.index(k) for k, _, _ in r[5]))))
    return field(1, b"".join(field(1, t.encode()) for t in texts)) + b"".join(field(2, g) for g in groups) + field(17, grain) + field(19, offset[0]) + field(20, offset[1])


PACK = {"raw": lambda d: field(1, d), "zlib": lambda d: field(2, len(d)) + field(3, zlib.compress(d)), "lzma": lambda d: field(2, len(d)) + field(4, lzma.compress(d)), "zstd": lambda d: field(2, len(d)) + field(7, zstandard.compress(d))}


def blob(kind, data, how):
    body = PACK[how](data)
    head = field(1, kind) + field(3, len(body))
    return len(head).to_bytes(4, "big") + head + body


@pytest.fixture(scope="module")
def world():
    rng = random.Random(3)
    rows = [("node", rng.randrange(1, 1 << 40) * rng.choice([1, 1, -1]), round(rng.uniform(-90, 90), 6), round(rng.uniform(-180, 180), 6), {f"k{rng.randrange(9)}": rng.choice(["ü", "yes", ""])} if rng.random() < 0.3 else {}, []) for _ in range(3_000)]
    ids = [r[1] for r in rows]
    rows += [("way", 10_000 + i, None, None, {"highway": rng.choice(["primary", "path"]), "name": "OSMData"}, [("node", rng.choice(ids), "") for _ in range(rng.randrange(0, 20))]) for i in range(400)]
    rows += [("relation", 50_000 + i, None, None, {}, [(rng.choice(mapfile.MEMBERS), rng.randrange(1, 99_999), rng.choice(["outer", ""])) for _ in range(rng.randrange(5))]) for i in range(100)]
    return rows


@pytest.fixture(scope="module")
def extract(world, tmp_path_factory):
    path = tmp_path_factory.mktemp("map") / "x.osm.pbf"
    out = blob(mapfile.HEADER, field(4, b"OsmSchema-V0.6") + field(4, b"DenseNodes"), "zlib")
    for i in range(0, len(world), 70):
        how = ["zlib", "raw", "zstd", "lzma"][i // 70 % 4]
        out += blob(mapfile.DATA, block(world[i : i + 70], dense=i // 70 % 3 != 0, grain=[100, 1000][i // 70 % 2], offset=(0, 0) if i % 2 else (5_000_000, -7_000_000)), how)
    path.write_bytes(out)
    return str(path)


def plain(rows):
    return sorted((r[0], r[1], r[2] and round(r[2], 6), r[3] and round(r[3], 6), tuple(sorted(r[4].items())), tuple(map(tuple, r[5]))) for r in rows)


@pytest.mark.parametrize("split", [64 << 20, 20_000, 977])
def test_an_extract_comes_back(spark, world, extract, split):
    rows = mapfile.read_extract(spark, extract, split)
    assert rows.schema == spark.createDataFrame([], elements.ELEMENT).schema
    assert plain(rows.collect()) == plain(world)
    assert plain(rows.filter("kind = 'way'").collect()) == plain([r for r in world if r[0] == "way"])
    roads = elements.completed(rows, elements.tagged(rows, "way", "highway", ["primary"]))
    used = {i for r in world if r[0] == "way" and r[4]["highway"] == "primary" for _, i, _ in r[5]}
    assert {r["id"] for r in roads.filter("kind = 'node'").collect()} == used


def test_a_condition_holds_where_it_is_asked_for(spark, world, extract):
    """Not in later uses of the same rows, nor in others of the same query."""
    rows, n = mapfile.read_extract(spark, extract), collections.Counter(r[0] for r in world)
    ways, nodes = (rows.filter(F.col("kind") == k) for k in ("way", "node"))
    assert (ways.count(), rows.count(), nodes.count(), rows.count()) == (n["way"], len(world), n["node"], len(world))
    assert {r["kind"]: r["count"] for r in ways.unionAll(nodes).groupBy("kind").count().collect()} == {"way": n["way"], "node": n["node"]}
    assert plain(mapfile.read_extract(spark, extract, kinds=["way", "relation"]).collect()) == plain([r for r in world if r[0] != "node"])


def test_bad_extracts(spark, tmp_path, extract):
    data = open(extract, "rb").read()
    (tmp_path / "cut").write_bytes(data[:-30])
    (tmp_path / "other").write_bytes(blob(mapfile.HEADER, field(4, b"LocationsOnWays2"), "raw"))
    (tmp_path / "empty").write_bytes(b"")
    for name, what in (("cut", "no blob"), ("other", "LocationsOnWays2")):
        with pytest.raises(Exception, match=what):
            mapfile.read_extract(spark, str(tmp_path / name)).count()
    assert mapfile.read_extract(spark, str(tmp_path / "empty")).count() == 0


# vector tiles


def tile(z, x, y):
    n = 1 << z

    def unit(lon, lat):
        return round(((lon + 180) / 360 * n - x) * 4096), round(((1 - math.asinh(math.tan(math.radians(lat))) / math.pi) / 2 * n - y) * 4096)

    return unit


def commands(parts, kind):
    out, at = [], (0, 0)
    if kind == 1:
        out.append(1 | len(parts) << 3)
    for part in parts:
        for k, p in enumerate(part[:-1] if kind == 3 else part):
            if kind != 1 and k < 2:
                out.append(9 if k == 0 else 2 | (len(part) - 1 - (kind == 3)) << 3)
            out += [zig(p[0] - at[0]), zig(p[1] - at[1])]
            at = p
        if kind == 3:
            out.append(15)
    return out


VALUES = [("BUS", field(1, b"BUS")), ("1.5", number(2 << 3 | 5) + struct.pack("<f", 1.5)), ("7", number(3 << 3 | 1) + struct.pack("<d", 7.0)), ("-3", field(4, -3)), ("12", field(5, 12)), ("-9", field(6, zig(-9))), ("true", field(7, 1)), ("false", field(7, 0))]


def layer(name, features):
    out = field(15, 2) + field(1, name.encode()) + field(5, 4096)
    for i, (kind, parts) in enumerate(features):
        out += field(2, field(1, 100 + i) + field(2, packed([0, i % len(VALUES), 1, 0])) + field(3, kind) + field(4, packed(commands(parts, kind))))
    return field(3, out + field(3, b"type") + field(3, b"x") + b"".join(field(4, v) for _, v in VALUES))


def test_tiles_of_a_box():
    assert tiles.tile_of(0, 0, 0) == (0, 0) and tiles.tile_of(180, -89, 3) == (7, 7) and tiles.tile_of(-180, 89, 3) == (0, 0)
    assert tiles.tile_of(11.35, 46.5, 10) == (544, 362)
    assert tiles.tiles_of((170, -1, -170, 1), 2) == [(3, 1), (3, 2), (0, 1), (0, 2)] and len(tiles.tiles_of((10, 46, 12.8, 47.2), 9)) == 5 * 4  # columns 270 to 274, rows 179 to 182


def test_tiles_as_rows(spark):
    box, zoom, asked = "11.3,46.4,11.9,46.6", 10, []
    at = tile(zoom, 544, 362)
    point, line, ring = [[at(11.35, 46.5)]], [[at(11.3, 46.45), at(11.4, 46.5), at(11.41, 46.48)]], [[at(11.3, 46.4), at(11.4, 46.4), at(11.4, 46.5), at(11.3, 46.4)], [at(11.31, 46.41), at(11.32, 46.41), at(11.32, 46.42), at(11.31, 46.41)]]
    data = layer("stops", [(1, point), (2, line), (3, ring), (1, [p for p in ([at(11.35, 46.5)], [at(11.36, 46.51)])])]) + layer("areas", [(3, ring)] * 5)

    def answer(method, path, headers, body):
        asked.append(path)
        return (200, {}, gzip.compress(data)) if path == "/stops,areas/10/544/362.pbf" else (404, {}, b"") if path.endswith("3.pbf") else (200, {}, b"")

    with serving(answer) as url:
        rows = tiles.read_tiles(spark, f"{url}/stops,areas/{{z}}/{{x}}/{{y}}.pbf", zoom, box)
        assert rows.rdd.getNumPartitions() == len(tiles.tiles_of(tuple(map(float, box.split(","))), zoom))
        found = rows.orderBy("layer", "ordinal").collect()
        shown = rows.filter("layer = 'stops'").select("id", D.match(F.col("tags.type"), {"BUS": "bus"}, "other").alias("icon")).collect()
    assert len(set(asked)) == len(tiles.tiles_of(tuple(map(float, box.split(","))), zoom))
    assert [(r["layer"], r["id"], r["geometry"]) for r in found] == [("areas", 100 + i, "Polygon") for i in range(5)] + [("stops", 100, "Point"), ("stops", 101, "LineString"), ("stops", 102, "Polygon"), ("stops", 103, "Point")]
    assert [r["tags"]["type"] for r in found[:5]] == [v for v, _ in VALUES[:5]] and all(r["tags"]["x"] == "BUS" for r in found)
    near = lambda p, lon, lat: abs(p["lon"] - lon) < 1e-4 and abs(p["lat"] - lat) < 1e-4
    assert near(found[5]["parts"][0][0], 11.35, 46.5) and [len(p) for p in found[7]["parts"]] == [4, 4] and found[7]["parts"][0][0] == found[7]["parts"][0][3]
    assert near(found[6]["parts"][0][2], 11.41, 46.48) and near(found[8]["parts"][1][0], 11.36, 46.51) and near(found[7]["parts"][1][1], 11.32, 46.41)
    assert {r["id"]: r["icon"] for r in shown}[100] == "bus" and {r["id"]: r["icon"] for r in shown}[101] == "other"
    for bad in ([1 | 1 << 3], [3 | 1 << 3, 0, 0]):
        with pytest.raises((ValueError, IndexError)):
            tiles.lines(bad)
