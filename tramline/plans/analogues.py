"""The star schema as mobility data, so that every operator can run on tables of any size.

Customers are stations, orders their bays, lines the vehicles; orders are charging stations too, lines their plugs; parts are map features, events are measurements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .feeds import ORIGINS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def variant(**fields: Column) -> Column:
    """An object as VARIANT; fields that are null are absent."""
    return F.parse_json(F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])))


def once(c: Column) -> Column:
    """c, made once for a row: filters and fields above are not pushed into it, as they would make it again each."""
    return F.explode(F.array(c))


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def point(key: str) -> Column:
    """Coordinates within a small region, by a key."""
    return F.struct((F.lit(10.0) + (F.col(key) % 281) / 100.0).alias("x"), (F.lit(46.0) + (F.col(key) % 121) / 100.0).alias("y"))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third customer belongs to another origin; some lack a total, some report their bikes themselves."""
    key = F.col("c_custkey")
    own = F.when(key % 11 == 0, F.struct(F.when(key % 22 != 0, F.col("c_nationkey") - 5).alias("number-available")))
    meta = variant(**{"address": F.col("c_mktsegment"), "total-bays": F.when(key % 7 != 0, (key % 13) * 2), "bikes": own})
    return table(spark, sf_dir, "customer").select(
        _text("c_custkey").alias("scode"),
        F.col("c_name").alias("sname"),
        F.when(key % 3 == 0, "OTHER").otherwise(ORIGINS["bz"]).alias("sorigin"),
        (F.col("c_acctbal") > -500).alias("sactive"),
        (F.col("c_nationkey") != 4).alias("savailable"),
        F.when(key % 5 != 0, point("c_custkey")).alias("scoordinate"),
        once(meta).alias("smetadata"),
        key.alias("ordinal"),
    )


def rental_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as stations of the third context, with hours that may lack parts."""
    n = F.col("s_nationkey")
    hours = variant(
        startHour=F.when(n % 5 != 0, F.concat(F.lpad((n % 9).cast("string"), 2, "0"), F.lit(":00"))).otherwise(""),
        endHour=F.when(n % 7 != 0, F.lit("19:00")),
        lunchBreakStart=F.when(n % 2 == 0, "12:00"),
        lunchBreakEnd=F.when(n % 4 == 0, "14:00"),
    )
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit(ORIGINS["papin"] + ":"), _text("s_suppkey")).alias("scode"),
        F.col("s_name").alias("sname"),
        F.lit(ORIGINS["papin"]).alias("sorigin"),
        (F.col("s_acctbal") > 0).alias("sactive"),
        F.lit(True).alias("savailable"),
        point("s_suppkey").alias("scoordinate"),
        hours.alias("smetadata"),
    )


def bays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(_text("o_orderkey").alias("scode"), _text("o_custkey").alias("pcode"), (F.col("o_orderstatus") != "F").alias("savailable"))


def bikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    electric = F.to_variant_object(F.struct((F.col("l_linestatus") == "O").alias("electric")))
    return table(spark, sf_dir, "lineitem").select(_text("l_orderkey").alias("pcode"), (F.col("l_returnflag") == "N").alias("savailable"), electric.alias("smetadata"))


def loose_bikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as bikes, some with a parent; flags as number, text or boolean."""
    key = F.col("p_partkey")
    flag = F.when(key % 4 == 0, F.parse_json(F.lit('{"future-availability":0,"in-maintenance":"1"}'))).when(key % 4 == 1, F.parse_json(F.lit('{"future-availability":"0","in-maintenance":null}')))
    flag = flag.when(key % 4 == 2, F.parse_json(F.lit('{"future-availability":null,"in-maintenance":1}'))).otherwise(F.parse_json(F.lit('{"in-maintenance":false,"future-availability":2}')))
    merged = F.parse_json(F.concat(F.lit('{"location_parking_name":"area_'), (F.col("p_size") % 40).cast("string"), F.lit('",'), F.substring(F.to_json(flag), 2, 1000)))
    return table(spark, sf_dir, "part").select(
        _text("p_partkey").alias("scode"), F.when(key % 6 == 0, F.lit("1")).when(key % 6 == 1, "").alias("pcode"), (key % 10 != 0).alias("sactive"), point("p_partkey").alias("scoordinate"), merged.alias("smetadata")
    )


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as drop-off areas: names repeat and have one or two underscores, polygons are text."""
    key = F.col("s_suppkey")
    lat, lon = F.concat(F.lit("46."), F.lpad((key % 97).cast("string"), 2, "0")), F.concat(F.lit("11."), F.lpad((key % 89).cast("string"), 2, "0"))
    corner = lambda a, b: F.concat(F.lit("("), lat, F.lit(a), F.lit(","), lon, F.lit(b), F.lit(")"))
    return table(spark, sf_dir, "supplier").select(
        _text("s_suppkey").alias("id"),
        F.concat(F.lit("area_"), (key % 30).cast("string"), F.when(key % 3 == 0, "_b").otherwise("")).alias("name"),
        lat.alias("lat"),
        lon.alias("lng"),
        F.col("s_name").alias("full_address"),
        F.concat_ws(", ", corner("1", "1"), corner("1", "5"), corner("5", "5"), corner("1", "1")).alias("polygon"),
        key.alias("ordinal"),
    )


def chargers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as charging stations."""
    key = F.col("o_orderkey")
    meta = variant(
        municipality=F.when(key % 3 == 0, F.concat(F.lit("SANKT "), F.col("o_orderpriority"))).when(key % 3 == 1, ""),
        city=F.lit("NEU-markt AM see"),
        accessType=F.when(key % 5 != 0, F.col("o_orderstatus")),
        capacity=F.when(key % 4 == 0, 0).when(key % 4 == 1, key % 9),
        provider=F.concat(F.lit("\t provider "), (key % 6).cast("string"), F.lit(" \n")),
        reservable=key % 2 == 0,
        state=F.col("o_orderstatus"),
    )
    return table(spark, sf_dir, "orders").select(
        _text("o_orderkey").alias("scode"), F.concat(F.lit("charger "), _text("o_orderkey")).alias("sname"), (F.col("o_orderstatus") != "P").alias("sactive"), point("o_orderkey").alias("scoordinate"), once(meta).alias("smetadata")
    )


def plugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as plugs: the type stands in the first outlet, on the plug, or nowhere."""
    n, kind = F.col("l_linenumber"), F.concat(F.lit("type "), F.col("l_returnflag"))
    outlet = F.array(F.struct(kind.alias("outletTypeCode"), F.col("l_quantity").alias("maxPower")))
    flat = F.struct(F.col("l_linestatus").alias("outletTypeCode"), F.lit(11.0).alias("maxPower"))
    absent = F.col("l_returnflag").isNull() | F.col("l_linestatus").isNull() | F.col("l_quantity").isNull() | n.isNull()
    # straight from columns, which takes a third of the time that JSON takes, where no field is absent
    meta = F.when(absent, variant(outlets=F.when(n % 3 == 0, outlet), outletTypeCode=F.when(n % 3 == 1, F.col("l_linestatus")), maxPower=F.when(n % 3 == 1, F.lit(11.0))))
    meta = meta.when(n % 3 == 0, F.to_variant_object(F.struct(outlet.alias("outlets")))).when(n % 3 == 1, F.to_variant_object(flat)).otherwise(F.parse_json(F.lit("{}")))
    value = F.when(F.col("l_quantity") > 25, F.parse_json(F.lit("1"))).when(F.col("l_quantity") > 15, F.parse_json(F.lit('"1"'))).otherwise(F.parse_json(F.lit("0")))
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", _text("l_orderkey"), _text("l_linenumber")).alias("scode"), _text("l_orderkey").alias("pcode"), _text("l_partkey").alias("sname"), value.alias("mvalue"), once(F.when(n != 7, meta)).alias("smetadata"), n.alias("ordinal")
    )


def stops(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers as stops whose routes are their orders, and nations as stations of two thirds of them."""
    mode = F.when(F.col("o_orderpriority").startswith("1"), "RAIL").when(F.col("o_orderpriority").startswith("2"), "AIRPLANE").when(F.col("o_orderpriority").startswith("5"), "FERRY").otherwise("BUS")
    route = F.struct(_text("o_orderkey").alias("gtfsId"), mode.alias("mode"))
    routes = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(route)).alias("routes"))
    customer = table(spark, sf_dir, "customer")
    parent = F.when(F.col("c_custkey") % 3 != 0, F.struct(_text("c_nationkey").alias("gtfsId"), F.lit("").alias("name")))
    rows = customer.join(routes, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.concat(F.lit("stop:"), _text("c_custkey")).alias("gtfsId"), F.col("c_name").alias("name"), parent.alias("parentStation"), F.coalesce("routes", F.array().cast(routes.schema["routes"].dataType)).alias("routes"), F.col("c_custkey").alias("ordinal")
    )
    nations = table(spark, sf_dir, "nation").select(_text("n_nationkey").alias("gtfsId"), F.col("n_name").alias("name"), F.col("n_nationkey").cast("bigint").alias("ordinal"))
    return rows, nations


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as map features with a zoom level."""
    size, key = F.col("p_size"), F.col("p_partkey")
    kinds = F.array(*map(F.lit, ["BUS", "RAIL", "BUS,RAIL", "RAIL,BUS", "TRAM"]))
    factors = F.array(*map(F.lit, ["BICYCLE", "CAR", "BICYCLE,CAR", "CAR,BICYCLE", "", "SCOOTER"]))
    pick = lambda a, c: F.get(a, c.cast("int"))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        pick(kinds, key % 5).alias("type"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("P"), size.cast("string")).alias("platform"),
        F.when(key % 4 == 0, "[]").when(key % 4 == 1, '["r"]').when(key % 4 == 2, "").alias("routes"),
        (F.lit(9) + key % 11).cast("int").alias("zoom"),
        pick(factors, size % 6).alias("formFactors"),
        F.when(key % 3 == 0, True).when(key % 3 == 1, False).alias("operative"),
        F.when(size % 5 != 0, size % 4).alias("vehiclesAvailable"),
        F.when(size % 2 == 0, size % 3).alias("capacity.carPlaces"),
        F.when(size % 3 == 0, size % 5).alias("capacity.bicyclePlaces"),
    )
