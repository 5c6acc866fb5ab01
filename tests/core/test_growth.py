"""What only odd or larger tables show: fractions of seconds, plans that must not grow with the tables."""

import datetime

from pyspark.sql import functions as F

from tramline import queries


def test_freshness_counts_fractions_of_seconds(spark, tmp_path):
    import duckdb

    now = datetime.datetime(2024, 1, 30, 23, 59, 25, 900_000)
    edge = now - datetime.timedelta(days=3)
    micro = datetime.timedelta(microseconds=1)
    times = [now, edge, edge - micro, edge + micro, edge - 800_000 * micro, edge - 950_000 * micro, edge + 200_000 * micro, None]
    spark.createDataFrame(list(enumerate(times)), "event_id long, ts timestamp_ntz").write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want = sorted(con.execute(queries.oracle_sql()["freshness"]).fetchall())
    assert want == [(2,), (4,), (5,)]
    assert sorted(tuple(r) for r in queries.freshness(spark, str(tmp_path)).collect()) == want


def test_points_at_one_spot_are_looked_up_once(spark, monkeypatch):
    from tramline.operators import nearest as module

    looked_up = []
    kept = module.kept

    def counting(df, name):
        out = kept(df, name)
        looked_up.extend([out.count()] if name == "nearest" else [])
        return out

    monkeypatch.setattr(module, "kept", counting)
    points = spark.range(500).select("id", (F.col("id") % 2 * 1.5).alias("lat"), F.lit(-0.0).alias("lon"))
    places = spark.range(7).select(F.col("id").alias("place_id"), (F.col("id") * 0.25).alias("lat"), F.lit(0.0).alias("lon"))
    rows = module.nearest(points, places, 3).collect()
    assert sorted((r["id"], r["rank"], r["place_id"]) for r in rows) == sorted((i, n + 1, p) for i in range(500) for n, p in enumerate([0, 1, 2] if i % 2 == 0 else [6, 5, 4]))
    assert sum(looked_up) == 2 * 3


def test_no_table_of_stations_is_broadcast(spark):
    from tramline.plans import feeds

    stations = spark.range(9).select(F.col("id").cast("string").alias("scode"), F.parse_json(F.lit('{"provider":"p"}')).alias("smetadata"))
    plugs = spark.range(9).select(F.lit("x").alias("scode"), F.col("id").cast("string").alias("pcode"), F.lit("n").alias("sname"), F.parse_json(F.lit("1")).alias("mvalue"), F.parse_json(F.lit("{}")).alias("smetadata"), F.lit(1).alias("ordinal"))
    plan = feeds.charger_facets(stations, plugs)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_only_plugs_of_listed_stations_are_opened(spark):
    from tramline.plans import feeds

    at = F.struct((F.lit(10.0) + F.col("id")).alias("x"), F.lit(46.0).alias("y"))
    stations = spark.range(9).select(F.col("id").cast("string").alias("scode"), F.lit("n").alias("sname"), F.lit(True).alias("sactive"), at.alias("scoordinate"), F.parse_json(F.lit('{"provider":"p"}')).alias("smetadata"))
    plugs = spark.range(9).select(F.lit("x").alias("scode"), F.col("id").cast("string").alias("pcode"), F.lit("n").alias("sname"), F.parse_json(F.lit("1")).alias("mvalue"), F.parse_json(F.lit('{"maxPower":3}')).alias("smetadata"), F.lit(1).alias("ordinal"))
    rows = feeds.charger_stations(stations, plugs, "11,46,12,47")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "Broadcast" not in plan
    assert sorted((r["station_id"], len(r["plugs"])) for r in rows.collect()) == [("1", 1), ("2", 1)]
