"""Geometry by built-in functions: bounding boxes, rings, containment, distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def parse_bbox(text: str | None) -> tuple[float, float, float, float] | None:
    """minx,miny,maxx,maxy. No text is no box; other than four parts is an error; a part that is no number matches nothing."""
    if not text:
        return None
    parts = text.split(",")
    if len(parts) != 4:
        raise ValueError("bbox parameter not valid")

    def number(x: str) -> float:
        try:
            return float(x) if x.strip() else 0.0
        except ValueError:
            return float("nan")

    return tuple(map(number, parts))


def in_bbox(x: Column, y: Column, box: tuple[float, float, float, float] | None) -> Column:
    """Inclusive on all sides; without a box, true. Plain comparisons, which reach the scan."""
    if box is None:
        return F.lit(True)
    if any(b != b for b in box):
        return F.lit(False)
    return (x >= box[0]) & (x <= box[2]) & (y >= box[1]) & (y <= box[3])


def ring(text: Column) -> Column:
    """(lat,lon), (lat,lon), ... as an array of [lon, lat]."""
    numbers = lambda p: F.transform(F.split(F.regexp_replace(p, "[()]", ""), ","), lambda n: n.try_cast("double"))
    return F.transform(F.split(text, ", "), lambda p: F.reverse(numbers(p)))


def multi_polygon(text: Column) -> Column:
    return F.array(F.array(ring(text)))


def in_ring(x: Column, y: Column, points: Column) -> Column:
    """Whether a closed ring of [x, y] goes round a point, by counting the edges that a ray to the right crosses."""

    def crossed(i: Column) -> Column:
        ax, ay = F.get(F.get(points, i), F.lit(0)), F.get(F.get(points, i), F.lit(1))
        bx, by = F.get(F.get(points, i + 1), F.lit(0)), F.get(F.get(points, i + 1), F.lit(1))
        return ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)

    edges = F.sequence(F.lit(0), F.size(points) - 2)
    return F.aggregate(edges, F.lit(False), lambda inside, i: inside != F.coalesce(crossed(i), F.lit(False)))


def inside(df: DataFrame, x: str, y: str, corners: list[tuple[float, float]]) -> DataFrame:
    """Rows whose point is in a ring; the ring's box is tested first and reaches the scan."""
    xs, ys = [p[0] for p in corners], [p[1] for p in corners]
    points = F.array(*[F.array(F.lit(float(a)), F.lit(float(b))) for a, b in corners])
    return df.filter(in_bbox(F.col(x), F.col(y), (min(xs), min(ys), max(xs), max(ys)))).filter(in_ring(F.col(x), F.col(y), points))


#: Metres of the sphere's radius.
RADIUS = 6_371_000


def distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres along a great circle."""
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * RADIUS * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def sphere(lat: str, lon: str) -> Column:
    """A place as x, y, z on a sphere of radius 1, where poles and meridians are places like others."""
    a, o = F.radians(F.col(lat)), F.radians(F.col(lon))
    return F.struct((F.cos(a) * F.cos(o)).alias("x"), (F.cos(a) * F.sin(o)).alias("y"), F.sin(a).alias("z"))


def sphere_cell(at: Column, side: Column) -> Column:
    """The cubic cell, of the given side, that a place on the sphere is in."""
    return F.struct(*[F.floor(at[c] / side).alias(c) for c in "xyz"])


def block(cell: Column) -> Column:
    """A cell and the 26 around it. Whatever is at most a side away from a place in the cell is in one of them."""
    steps = [(i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]
    return F.array(*[F.struct(*[(cell[c] + d).alias(c) for c, d in zip("xyz", step)]) for step in steps])


def within(left: DataFrame, right: DataFrame, metres: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Pairs of rows at most so far apart, anywhere on the sphere, by an equi-join of cubic cells; columns of right get the prefix other_."""
    side = F.lit(max(metres, 0.01) / RADIUS * (1 + 1e-9))
    a = left.withColumn("_cell", sphere_cell(sphere(lat, lon), side))
    b = right.select([F.col(c).alias(f"other_{c}") for c in right.columns])
    b = b.withColumn("_cell", F.explode(block(sphere_cell(sphere(f"other_{lat}", f"other_{lon}"), side))))
    pairs = a.join(b, "_cell").withColumn("metres", distance(F.col(lat), F.col(lon), F.col(f"other_{lat}"), F.col(f"other_{lon}")))
    return pairs.filter(F.col("metres") <= metres).drop("_cell")
