"""Cells, nearest places and map elements against plain versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tramline.functions import cells, geo
from tramline.operators import relate
from tramline.operators.nearest import nearest
from tramline.plans import elements


def star(rng, x, y, r, n):
    corners = [(x + r * rng.uniform(0.3, 1) * math.cos(2 * math.pi * k / n), y + r * rng.uniform(0.3, 1) * math.sin(2 * math.pi * k / n)) for k in range(n)]
    return [list(p) for p in [*corners, corners[0]]]


def crossed(ring, x, y):
    inside = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:]):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            inside = not inside
    return inside


@pytest.mark.parametrize("depth", [0, 3, 7])
def test_points_in_many_rings(spark, depth):
    rng = random.Random(depth)
    rings = [(f"r{k}", star(rng, rng.uniform(-60, 60), rng.uniform(-40, 40), 10 ** rng.uniform(-2, 1.4), rng.randrange(3, 40))) for k in range(25)]
    rings += [("square", [[0.0, 0.0], [0.0, 10.0], [10.0, 10.0], [10.0, 0.0], [0.0, 0.0]]), ("flat", [[0.0, 0.0], [1.0, 0.0], [2.0, 0.0], [0.0, 0.0]])]
    odd = [("short", [[0.0, 0.0], [1.0, 1.0]]), ("null", None), ("hole", [[0.0, 0.0], None, [1.0, 1.0], [0.0, 0.0]])]
    points = [(i, rng.uniform(-70, 70), rng.uniform(-50, 50)) for i in range(1_500)]
    points += [(2_000 + i, ring[0][0] + rng.uniform(-0.02, 0.02), ring[0][1] + rng.uniform(-0.02, 0.02)) for i, (_, ring) in enumerate(rings * 8)]
    points += [(3_000 + i, float(i % 12 - 1), float(i // 12 - 1)) for i in range(144)]  # on edges and corners
    table = spark.createDataFrame([*points, (9_000, None, 1.0), (9_001, 1.0, None)], "id int, x double, y double").withColumn("cx", F.lit("clash")).withColumn("inner", F.lit(1))
    shapes = spark.createDataFrame(rings + odd, "ring_id string, ring array<array<double>>")
    out = cells.points_in_rings(table, shapes, depth=depth, cast="cast").collect()
    want = sorted((i, name) for i, x, y in points for name, ring in rings if crossed(ring, x, y))
    assert sorted((r["id"], r["ring_id"]) for r in out) == want and all(r["cx"] == "clash" for r in out)
    share = sum(r["cast"] for r in out) / len(out)
    assert share == 1 if depth == 0 else share < (0.75 if depth == 3 else 0.45)


def test_a_cover_holds_all_that_is_inside():
    rng = random.Random(9)
    ring = np.array(star(rng, 11, 46, 2, 41))
    found = cells.ring_cells(ring, depth=6)
    at = {}
    for level, cx, cy, inner in found:
        side = cells.WORLD[2] / 2**level
        at[level, cx, cy] = inner
    levels = sorted({k[0] for k in at})
    for _ in range(3_000):
        x, y = rng.uniform(9, 13), rng.uniform(44, 48)
        hits = [at[k] for level in levels if (k := (level, math.floor((x + 180) / 360 * 2**level), math.floor((y + 180) / 360 * 2**level))) in at]
        assert len(hits) <= 1
        assert crossed(ring.tolist(), x, y) if hits == [True] else hits or not crossed(ring.tolist(), x, y)
    assert side > 0 and len(found) < 3_000


def metres(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6_371_000 * math.asin(math.sqrt(min(1, h)))


@pytest.fixture(scope="module")
def globe():
    rng = random.Random(5)
    spots = [(math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for _ in range(150)]
    spots += [(46.5 + rng.uniform(-1e-3, 1e-3), 11.3 + rng.uniform(-1e-3, 1e-3)) for _ in range(120)] + [(10.0, 179.9999), (10.0, -179.9999), (89.9999, 5.0), (89.9999, -175.0), (-90.0, 0.0), (-90.0, 90.0)]
    return spots + [(46.5, 11.3)] * 60  # a crowd at one spot


def test_pairs_within_a_distance_everywhere(spark, globe):
    table = spark.createDataFrame([(i, *p) for i, p in enumerate(globe)], "id int, lat double, lon double")
    for limit in (50, 3_000, 500_000):
        out = {(r["id"], r["other_id"]) for r in geo.within(table, table, limit).select("id", "other_id").collect()}
        assert out == {(i, j) for i, a in enumerate(globe) for j, b in enumerate(globe) if metres(a, b) <= limit}


@pytest.mark.parametrize("k", [1, 6])
def test_nearest(spark, globe, k):
    places = spark.createDataFrame([(i, *p) for i, p in enumerate(globe)] + [(999, None, 1.0)], "place_id int, lat double, lon double")
    queries = globe[::7] + [(0.0, 0.0), (46.5, 11.3), (-90.0, 7.0)]
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(queries)] + [(998, 1.0, None)], "id int, lat double, lon double")
    got = {}
    for r in nearest(points, places, k).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["place_id"]))
    assert set(got) == set(range(len(queries)))
    for i, a in enumerate(queries):
        want = sorted((round(metres(a, b), 3), j) for j, b in enumerate(globe))[:k]
        assert [p for _, p in sorted(got[i])] == [j for _, j in want] and [r for r, _ in sorted(got[i])] == list(range(1, k + 1))


def test_nearest_of_few(spark):
    places = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 180.0)], "place_id int, lat double, lon double")
    points = spark.createDataFrame([(7, 1.0, 1.0)], "id int, lat double, lon double")
    assert [r["place_id"] for r in nearest(points, places).orderBy("rank").collect()] == [1, 2]
    assert nearest(points.limit(0), places).count() == 0 and nearest(points, places.limit(0)).count() == 0


# elements


def make(spark, rows):
    return spark.createDataFrame([(k, i, None, None, t, r) for k, i, t, r in rows], elements.ELEMENT)


N, W, R = elements.NODE, elements.WAY, elements.RELATION
REF = lambda kind, *ids: [(kind, i, "") for i in ids]


def test_merge_and_completion(spark):
    first = make(spark, [(N, 1, {"v": "a"}, []), (N, 2, None, None), (W, 1, {"highway": "primary"}, REF(N, 1, 2, 1)), (R, 1, {"type": "route"}, REF(W, 1) + REF(R, 2))])
    second = make(spark, [(N, 1, {"v": "b"}, []), (N, 3, None, []), (W, 2, {"highway": "path"}, REF(N, 3, 4)), (R, 2, None, REF(R, 3)), (R, 3, None, REF(R, 1) + REF(N, 3)), (R, 9, None, REF(W, 2))])
    both = elements.merge(first, second)
    keyed = lambda df: sorted((r["kind"], r["id"]) for r in df.collect())
    assert len(keyed(both)) == 9 and {r["tags"]["v"] for r in both.filter("kind = 'node' and id = 1").collect()} == {"a"}
    assert keyed(elements.dangling(both)) == [(N, 4)]
    roads = elements.completed(both, elements.tagged(both, W, "highway", ["primary", "secondary"]))
    assert keyed(roads) == [(N, 1), (N, 2), (W, 1)] and keyed(elements.dangling(roads)) == []
    circle = elements.completed(both, both.filter("kind = 'relation' and id = 1"))  # 1 -> 2 -> 3 -> 1
    assert keyed(circle) == [(N, 1), (N, 2), (N, 3), (R, 1), (R, 2), (R, 3), (W, 1)]
    assert keyed(elements.completed(both, both.limit(0))) == [] and keyed(elements.tagged(both, W, "highway")) == [(W, 1), (W, 2)]


def test_probe_takes_only_wanted_rows(spark):
    index = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (3, 9, "d")], "id int, ordinal int, v string")
    wanted = spark.createDataFrame([(1,), (1,), (3,), (7,), (None,)], "id int")
    out = relate.probe(wanted, index, "id", "ordinal")
    assert sorted((r["id"], r["v"]) for r in out.collect()) == [(1, "b"), (1, "b"), (3, "d")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
