"""The k nearest places of many points, by growing blocks of cells on the sphere."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import RADIUS, block, distance, sphere, sphere_cell
from ..sources.files import kept

#: Sides of cells, on a sphere of radius 1, from coarse to fine: from all of it down to some decimetres.
SIDES = [2.0 * 4.0**-j for j in range(13)]
#: The first round takes the coarsest cells of which none holds more than so many times k places.
CROWD = 2
#: Spots of points that a task takes at once, about.
SPOTS = 4_000
_SPOT = ["_y", "_x"]


def nearest(points: DataFrame, places: DataFrame, k: int = 6, key: str = "id", place: str = "place_id", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """The k nearest places of each point: key, rank (from 1), place, metres (rounded to a thousandth, by which they are ordered; ties by id).

    Keys of points and ids of places differ. Points or places without coordinates are left out; where there are fewer
    than k places, a point has all of them. Of places at one spot only the k least ids can count, so a crowd at a spot is cut down before it meets anyone,
    and points at one spot have the same k nearest, so each spot is looked up once and its points are joined to what it has. A
    round joins the spots that are left with the places in the 27 cells around them, keeps the k best of each spot in every task before
    they are shuffled, and settles the spots whose k best lie within what the block is sure to hold; the others go on with wider cells.
    """
    spark = points.sparkSession
    sides = SIDES
    at_one = Window.partitionBy("_lat", "_lon").orderBy("_place")
    there = places.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.col(place).alias("_place"), F.col(lat).cast("double").alias("_lat"), F.col(lon).cast("double").alias("_lon"))
    there = kept(there.withColumn("_r", F.row_number().over(at_one)).filter(F.col("_r") <= k).drop("_r").withColumn("_s", sphere("_lat", "_lon")), "places")
    asked = kept(points.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.col(key).alias("_key"), F.col(lat).cast("double").alias("_y"), F.col(lon).cast("double").alias("_x")), "points")
    left = kept(asked.select(*_SPOT).distinct(), "spots")
    open_spots = left.count()
    levels = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.lit(s).alias("side")) for j, s in enumerate(sides)]))
    counted = there.select("_s", levels.alias("l")).groupBy(F.col("l.j").alias("j"), sphere_cell(F.col("_s"), F.col("l.side")).alias("c")).count().groupBy("j").agg(F.max("count").alias("most"))
    crowded = {r["j"]: r["most"] for r in counted.collect()}
    first = next((j for j in range(len(sides)) if crowded.get(j, 0) <= CROWD * k), len(sides) - 1)
    best = Window.partitionBy(*_SPOT).orderBy("metres", "_place")
    done = None
    for j in range(first, -1, -1):
        side, left = sides[j], left.repartition(open_spots // SPOTS + 1, *_SPOT)
        near = left.select("*", F.explode(block(sphere_cell(sphere("_y", "_x"), F.lit(side)))).alias("_c")).join(there.withColumn("_c", sphere_cell(F.col("_s"), F.lit(side))), "_c")
        ranked = near.select(*_SPOT, "_place", F.round(distance(F.col("_y"), F.col("_x"), F.col("_lat"), F.col("_lon")), 3).alias("metres"))
        ranked = ranked.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        if j:
            sure = 2 * RADIUS * math.asin(min(1.0, side * (1 - 1e-9) / 2)) - 0.001
            ranked = ranked.withColumn("_far", F.max(F.when(F.col("rank") == k, F.col("metres"))).over(Window.partitionBy(*_SPOT))).filter(F.col("_far") <= sure).drop("_far")
        ranked = kept(ranked, "nearest")
        done = ranked if done is None else done.unionAll(ranked)
        if j:
            left = kept(left.join(ranked.filter("rank = 1").select(*_SPOT), _SPOT, "left_anti"), "spots")
            open_spots = left.count()
            if not open_spots:
                break
    row = F.struct("rank", F.col("_place").alias("place"), "metres")
    lists = done.groupBy(*_SPOT).agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    out = asked.join(lists, _SPOT).select("_key", F.explode("_rows").alias("_r"))
    return out.select(F.col("_key").alias(key), F.col("_r.rank").alias("rank"), F.col("_r.place").alias(place), F.col("_r.metres").alias("metres"))
