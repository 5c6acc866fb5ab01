"""Points in many rings, by a hierarchy of cells: a cell inside a ring answers for all its points, only points in border cells are cast."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.files import kept
from .geo import in_ring

#: The square that level 0 is, as its left, its bottom and its side.
WORLD = (-180.0, -180.0, 360.0)
#: Levels below that of a cell as large as the ring. Border cells grow as 2 to this number.
DEPTH = 6
#: A cell counts as touched from so many of its sides away, so that rounding decides nothing.
_MARGIN = 1e-6


def _touched(edges: np.ndarray, x: float, y: float, side: float) -> np.ndarray:
    """Which edges (rows of ax, ay, bx, by) meet a square: their boxes overlap, and its corners are not all on one side of the line."""
    x0, y0, x1, y1 = x - side * _MARGIN, y - side * _MARGIN, x + side * (1 + _MARGIN), y + side * (1 + _MARGIN)
    ax, ay, bx, by = edges.T
    near = (np.minimum(ax, bx) <= x1) & (np.maximum(ax, bx) >= x0) & (np.minimum(ay, by) <= y1) & (np.maximum(ay, by) >= y0)
    side_of = [(bx - ax) * (cy - ay) - (by - ay) * (cx - ax) for cx in (x0, x1) for cy in (y0, y1)]
    return near & (np.minimum.reduce(side_of) <= 0) & (np.maximum.reduce(side_of) >= 0)


def _inside(edges: np.ndarray, x: float, y: float) -> bool:
    ax, ay, bx, by = edges.T
    crosses = (ay > y) != (by > y)
    if not crosses.any():
        return False
    ax, ay, bx, by = edges[crosses].T
    return bool((x < (bx - ax) * (y - ay) / (by - ay) + ax).sum() % 2)


def ring_cells(ring: np.ndarray, world: tuple[float, float, float] = WORLD, depth: int = DEPTH) -> list[tuple[int, int, int, bool]]:
    """(level, column, row, inner) of disjoint cells that together hold every point inside the ring."""
    edges = np.hstack([ring[:-1], ring[1:]])
    if not len(edges) or not np.isfinite(edges).all():
        return []
    left, bottom, size = world
    extent = max(np.ptp(ring[:, 0]), np.ptp(ring[:, 1]), size * 2.0**-40)
    top = max(0, math.floor(math.log2(size / extent)))
    side, out = size / 2**top, []
    span = lambda v, o: range(math.floor((v.min() - o) / side - _MARGIN), math.floor((v.max() - o) / side + _MARGIN) + 1)
    work = [(top, cx, cy, edges) for cx in span(ring[:, 0], left) for cy in span(ring[:, 1], bottom)]
    while work:
        level, cx, cy, near = work.pop()
        side = size / 2**level
        x, y = left + cx * side, bottom + cy * side
        near = near[_touched(near, x, y, side)]
        if not len(near):
            if _inside(edges, x + side / 2, y + side / 2):
                out.append((level, cx, cy, True))
        elif level - top >= depth:
            out.append((level, cx, cy, False))
        else:
            work += [(level + 1, 2 * cx + i, 2 * cy + j, near) for i in (0, 1) for j in (0, 1)]
    return out


def _cells(world: tuple[float, float, float], depth: int, kind: pa.DataType):
    schema = pa.schema([("ring_id", kind), ("level", pa.int32()), ("cx", pa.int64()), ("cy", pa.int64()), ("inner", pa.bool_())])

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, ring in zip(batch.column(0), batch.column(1).to_pylist()):
                usable = ring and len(ring) > 3 and all(p and len(p) >= 2 and None not in p[:2] for p in ring)
                found = ring_cells(np.array([p[:2] for p in ring], float), world, depth) if usable else []
                if found:
                    columns = [pa.array([key.as_py()] * len(found), kind), *(pa.array(c, f.type) for c, f in zip(zip(*found), list(schema)[1:]))]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return cells


def cover(rings: DataFrame, ring_id: str = "ring_id", ring: str = "ring", depth: int = DEPTH, world: tuple[float, float, float] = WORLD) -> DataFrame:
    """Cells of rings (closed, arrays of [x, y]): ring_id, level, cx, cy, inner. Rings of less than four points, or with nulls, have none."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rings.schema[ring_id].dataType
    return rings.select(ring_id, ring).mapInArrow(_cells(world, depth, to_arrow_type(kind)), f"ring_id {kind.simpleString()}, level int, cx long, cy long, inner boolean")


def points_in_rings(points: DataFrame, rings: DataFrame, x: str = "x", y: str = "y", ring_id: str = "ring_id", ring: str = "ring", depth: int = DEPTH, world: tuple[float, float, float] = WORLD, cast: str | None = None) -> DataFrame:
    """Rows of points with the id of each ring that goes round them, as by `in_ring`; points in several rings come several times.

    A point is looked up once for each level of the cover, which is an equi-join; rings travel only to points in their border
    cells. cast: the name of a boolean column that says whether the point was cast. Null coordinates are in no ring.
    """
    cells = kept(cover(rings, ring_id, ring, depth, world), "cover")
    levels = [r["level"] for r in cells.select("level").distinct().orderBy("level").collect()]
    if not levels:
        levels = [0]
    left, bottom, size = world
    at = lambda c, o: F.floor((F.col("_at")[c] - F.lit(o)) / F.lit(size) * F.pow(F.lit(2.0), F.col("level")))
    rows = points.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.struct(*[F.col(f"`{c}`") for c in points.columns]).alias("_row"), F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).alias("_at"))
    looked = rows.select("*", F.explode(F.array(*map(F.lit, levels))).alias("level")).select("*", at("x", left).alias("cx"), at("y", bottom).alias("cy"))
    hits = looked.join(cells, ["level", "cx", "cy"])
    shapes = rings.select(F.col(ring_id).alias("ring_id"), F.col(ring).alias("_ring"))
    border = hits.filter(~F.col("inner")).join(shapes, "ring_id").filter(in_ring(F.col("_at.x"), F.col("_at.y"), F.col("_ring")))
    columns = [F.col("_row")[c].alias(c) for c in points.columns] + [F.col("ring_id").alias(ring_id)]
    mark = lambda value: [F.lit(value).alias(cast)] if cast else []
    return hits.filter("inner").select(*columns, *mark(False)).unionAll(border.select(*columns, *mark(True)))
