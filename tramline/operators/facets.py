"""Facets: the distinct values of several columns, in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def facets(df: DataFrame, columns: list[str], missing: str = "undefined") -> DataFrame:
    """Rows (facet, value) of the distinct values, as text, of each column; null is the text given. An empty table has no facets."""
    texts = df.select([F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias(c) for c in columns])
    return texts.unpivot([], columns, "facet", "value").distinct()


def facet_document(rows: DataFrame, labels: dict[str, str]) -> dict:
    """Facets as a nested document; the values of facets are few and are collected, the facets in the order of labels."""
    found: dict[str, list[str]] = {k: [] for k in labels}
    for r in rows.orderBy("facet", "value").collect():
        found.setdefault(r["facet"], []).append(r["value"])
    return {"filters": {k: {"enabled": True, "label": labels.get(k, f"label_{k.lower()}"), "values": [{"value": v, "enabled": True} for v in vs]} for k, vs in found.items()}}
