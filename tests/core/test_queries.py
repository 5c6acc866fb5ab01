"""Every registered query of the core against its SQL on the smallest tables."""

import os

import pytest

from tramline import queries

FOLDER = "/root/testdata/sf0.001"


def plain(value):
    if value is None or value != value:
        return None
    if isinstance(value, float):
        return round(value, 6)
    return value


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([plain(r[i]) for i in order]) for r in records)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{FOLDER}/{f}'")
    want = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    out = queries.queries()[name](spark, FOLDER)
    assert sorted(out.columns) == sorted(columns)
    number = lambda rs: [[float(x) if isinstance(x, int | float) and not isinstance(x, bool) else x for x in r] for r in rs]
    assert rows(out.columns, number([list(r) for r in out.collect()])) == rows(columns, number(want.fetchall()))


def test_pushdown_reaches_the_scan(spark):
    from tramline.functions import geo
    from pyspark.sql import functions as F

    if os.path.isdir(FOLDER):
        df = geo.inside(spark.read.parquet(f"{FOLDER}/customer.parquet").select(F.col("c_acctbal").alias("x"), F.col("c_acctbal").alias("y")), "x", "y", [(0, 0), (5, 0), (5, 5), (0, 0)])
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(c_acctbal,0.0)" in plan.replace(" ", "")
