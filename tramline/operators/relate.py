"""Relating parents and children: lookups, counts, nesting, roll-up, last values. Every order is an explicit column.

What is made of children grows with the parents, and the estimate of its size may be far too low, so it is merged and never broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_match(left: DataFrame, right: DataFrame, on: Column, key: str, order: str, value: str, default=None, name: str = "found") -> DataFrame:
    """Adds the value of the first row of right (by order) whose key equals `on`, or the default. Rows of left don't multiply."""
    one = right.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(F.col(value).alias("v")), order).alias("_v"))
    out = left.join(one, on == F.col("_key"), "left")
    found = F.col("_v.v") if default is None else F.coalesce("_v.v", F.lit(default))
    return out.withColumn(name, found).drop("_key", "_v")


def count_children(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, **counts: Column) -> DataFrame:
    """Adds sums over the children of each parent, 0 without any. Children are added up before the join."""
    added = children.groupBy(F.col(child_key).alias("_parent")).agg(*[c.alias(n) for n, c in counts.items()])
    out = parents.join(added.hint("merge"), F.col(parent_key) == F.col("_parent"), "left").drop("_parent")
    return out.withColumns({n: F.coalesce(n, F.lit(0).cast("bigint")) for n in counts})


def nest_children(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, order: str, fields: list[str], name: str) -> DataFrame:
    """Adds each parent's children as an array of structs, in order; an empty array without any."""
    row = F.struct(F.col(order).alias("_order"), F.struct(*fields).alias("row"))
    nested = children.groupBy(F.col(child_key).alias("_parent")).agg(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["row"]).alias(name))
    out = parents.join(nested.hint("merge"), F.col(parent_key) == F.col("_parent"), "left").drop("_parent")
    return out.withColumn(name, F.coalesce(name, F.array().cast(nested.schema[name].dataType)))


def last_by(df: DataFrame, key: str | list[str], order: Column | str) -> DataFrame:
    """The last row of each key."""
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def probe(wanted: DataFrame, index: DataFrame, key: str, order: str) -> DataFrame:
    """The row of index for each wanted id, in the wanted rows' number; of repeated ids the last counts. Unknown ids give nothing.

    Rows that nobody wants leave before the last of each id is looked for.
    """
    asked = index.join(wanted.select(key).distinct(), key, "left_semi")
    return wanted.select(key).join(last_by(asked, key, order), key)


def missing(wanted: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """Wanted rows that the index doesn't know."""
    return wanted.join(index, key, "left_anti")


def pivot_last(df: DataFrame, key: str, name: str, value: str, order: Column | str, names: list[str], keep_first: list[str] = ()) -> DataFrame:
    """Long to wide: for each key the last value of each name; kept columns come from its first row, of whatever name."""
    columns = [F.expr(f"max_by({value}, {order}) FILTER (WHERE {name} = '{n}')").alias(n) for n in names]
    return df.groupBy(key).agg(*columns, *[F.min_by(c, order).alias(c) for c in keep_first])


def roll_up(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str, order: str, distinct: str, appended: str) -> DataFrame:
    """Parents with at least one child: the union of one array column, distinct, and all of another, repeats kept."""
    row = F.struct(order, distinct, appended)
    lists = children.groupBy(F.col(child_key).alias("_parent")).agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    both = lists.select("_parent", F.array_distinct(F.flatten(F.col(f"_rows.{distinct}"))).alias(distinct), F.flatten(F.col(f"_rows.{appended}")).alias(appended))
    return parents.join(both.hint("merge"), F.col(parent_key) == F.col("_parent")).drop("_parent")


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows, by column name; a column that one side lacks is null there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def merge_distinct(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both, one per key; where both have a key, the first's row."""
    ranked = first.withColumn("_side", F.lit(0)).unionByName(second.withColumn("_side", F.lit(1)))
    return last_by(ranked, keys, -F.col("_side")).drop("_side")
