"""A REST source of located rows: comparisons of coordinates become the box of the request."""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from .rest import fetch

#: What stands for a side without a bound, as minx, miny, maxx, maxy.
WORLD = (-180.0, -90.0, 180.0, 90.0)


class _Strip(InputPartition):
    def __init__(self, box: tuple[float, float, float, float] | None, open_right: bool = False, nothing: bool = False):
        self.box, self.open_right, self.nothing = box, open_right, nothing


def _number(value) -> bool:
    return isinstance(value, int | float) and not isinstance(value, bool) and math.isfinite(value)


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.where = options["url"], options.get("where", "")
        self.items, self.point, self.strips = options.get("items", "data"), options.get("point", "scoordinate"), int(options.get("strips", 1))
        self.exact = options.get("exact", "true").lower() == "true"
        self.low, self.high, self.boxed = {"x": -math.inf, "y": -math.inf}, {"x": math.inf, "y": math.inf}, False

    def pushFilters(self, filters: list) -> Iterable:
        """Bounds of x and y that the box expresses are taken; all others are left to Spark. A strict bound widens the box to its closed form and is left, too."""
        filters = list(filters)
        left = []
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            values = (f.value if isinstance(f, In) else [f.value]) if name in ("x", "y") and hasattr(f, "value") else []
            if not self.where or not values or not all(map(_number, values)) or not isinstance(f, EqualTo | In | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual):
                left.append(f)
                continue
            if not isinstance(f, LessThan | LessThanOrEqual):
                self.low[name] = max(self.low[name], min(values))
            if not isinstance(f, GreaterThan | GreaterThanOrEqual):
                self.high[name] = min(self.high[name], max(values))
            self.boxed = True
            if isinstance(f, In | GreaterThan | LessThan) or not self.exact:
                left.append(f)
        # what is in the box has coordinates, and every row has its ordinal
        sure = {("x",), ("y",), ("ordinal",)} if self.boxed else {("ordinal",)}
        return [f for f in left if not (isinstance(f, IsNotNull) and f.attribute in sure)]

    def partitions(self) -> list[_Strip]:
        """The box in strips from left to right, one request each; a box that nothing can be in needs none."""
        if not self.boxed:
            return [_Strip(None)]
        (x0, x1), (y0, y1) = ((max(self.low[c], WORLD[i]), min(self.high[c], WORLD[i + 2])) for i, c in enumerate("xy"))
        if x0 > x1 or y0 > y1:
            return [_Strip(None, nothing=True)]
        n = self.strips if x1 > x0 else 1
        edges = [x0 + (x1 - x0) * k / n for k in range(n)] + [x1]
        return [_Strip((a, y0, b, y1), k < n - 1) for k, (a, b) in enumerate(zip(edges, edges[1:]))]

    def read(self, strip: _Strip) -> Iterator[tuple]:
        if strip.nothing:
            return
        box = strip.box and self.where.replace("{box}", ",".join(f"{v:.17g}" for v in strip.box))
        for ordinal, item in enumerate(fetch(self.url + (box or "")).get(self.items) or []):
            point = item.get(self.point) or {}
            x, y = ((float(point[c]) if point.get(c) is not None else None) for c in "xy")
            if not (strip.open_right and x is not None and x >= strip.box[2]):  # it is in the next strip, too
                yield (x, y, ordinal, json.dumps(item, ensure_ascii=False))


class BoxedRest(DataSource):
    """format("boxed_rest"): options url, where (what is appended to it if there is a box, with {box} for minx,miny,maxx,maxy),
    items (the key of the rows), point (the key of an object with x and y), strips (requests that share the box), exact.

    Columns x, y, ordinal (within a reply) and item (JSON text). The service is taken to have both coordinates or none, and to return
    exactly the rows within a box, edges included; if it returns more, set exact to false, and Spark filters again.
    """

    @classmethod
    def name(cls) -> str:
        return "boxed_rest"

    def schema(self) -> str:
        return "x double, y double, ordinal long, item string"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def read_located(spark: SparkSession, url: str, where: str, strips: int = 1, exact: bool = True, **options: str) -> DataFrame:
    """Located rows of a service; filter the result by x and y, and the request is for no more.

    What a Python reader takes of a query's filters holds for later uses of the same DataFrame that have none, so each use has one, which every row
    meets. Within one query, uses with different boxes need a DataFrame each: the box of the last would hold for all.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BoxedRest)
    return spark.read.format("boxed_rest").options(url=url, where=where, strips=strips, exact=exact, **options).load().filter("ordinal IS NOT NULL")
