"""Map elements: extracts merged by kind and id, selections by tag, and what they refer to, completed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.files import kept

NODE, WAY, RELATION = "node", "way", "relation"
#: Columns of an element; coordinates are those of nodes.
ELEMENT = "kind string, id long, lat double, lon double, tags map<string,string>, refs array<struct<kind:string,id:long,role:string>>"
_KEY = ["kind", "id"]


def merge(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Elements of several extracts, one for each kind and id; where several extracts have it, that of the first of them."""
    ranked = None
    for place, extract in enumerate((first, *others)):
        rows = extract.select(*_KEY, F.struct(F.lit(place).alias("place"), F.struct(*[c for c in first.columns if c not in _KEY]).alias("rest")).alias("e"))
        ranked = rows if ranked is None else ranked.unionAll(rows)
    return ranked.groupBy(*_KEY).agg(F.min_by("e", "e.place").alias("e")).select(*_KEY, "e.rest.*").select(first.columns)


def tagged(elements: DataFrame, kind: str, key: str, values: list[str] | None = None) -> DataFrame:
    """Elements of a kind with a tag, of one of the values if they are given."""
    value = F.col("tags")[key]
    return elements.filter((F.col("kind") == kind) & (value.isin(values) if values is not None else value.isNotNull()))


def _refs(elements: DataFrame) -> DataFrame:
    return elements.select(F.explode("refs").alias("r")).select("r.kind", "r.id").distinct()


def completed(elements: DataFrame, chosen: DataFrame) -> DataFrame:
    """The chosen elements (by kind and id) and all that they refer to, also over relations of relations.

    A round takes what the last one has added, and adds what that refers to and is not yet there; it ends when there is nothing new, which also
    ends circles of relations. Each round shuffles keys only; elements as a whole are read once more at the end.
    """
    graph = kept(elements.select(*_KEY, F.transform("refs", lambda r: F.struct(r["kind"].alias("kind"), r["id"].alias("id"))).alias("refs")), "graph")
    links, known = graph.filter(F.size("refs") > 0), graph.select(*_KEY)
    found = fresh = kept(known.join(chosen.select(*_KEY).distinct(), _KEY, "left_semi").distinct(), "chosen")
    while fresh.take(1):
        wanted = _refs(links.join(fresh, _KEY, "left_semi")).join(found, _KEY, "left_anti")
        fresh = kept(wanted.join(known, _KEY, "left_semi"), "fresh")
        found = found.unionAll(fresh)
    return elements.join(found, _KEY, "left_semi")


def dangling(elements: DataFrame) -> DataFrame:
    """Kinds and ids that are referred to but are not there."""
    return _refs(elements).join(elements.select(*_KEY), _KEY, "left_anti")
