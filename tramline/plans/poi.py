"""Stops, places and accommodation for a search index: roll-up, popularity, categories, export rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import prefixed_lower, slug, whole_record
from ..operators.relate import first_match, roll_up, union_all

# Weights of modes, of a route, names of categories.
MODE_WEIGHTS = {"AIRPLANE": 1500, "RAIL": 1000, "BUS": 500, "TRAM": 500, "GONDOLA": 500, "FUNICULAR": 500}
ROUTE_WEIGHT = 250
STOP_CATEGORIES = ["public_transport", "public_transport:stop"]


def popularity(modes: Column, n_routes: Column, weights: dict[str, int] = MODE_WEIGHTS, route_weight: int = ROUTE_WEIGHT) -> Column:
    """Weights of the modes that are there, and of every route, repeats included."""
    total = n_routes * route_weight
    for mode, weight in weights.items():
        total = total + F.when(F.array_contains(modes, mode), weight).otherwise(0)
    return total.cast("bigint")


def routed(stops: DataFrame) -> DataFrame:
    """Stops with routes; their modes are those of the routes, distinct, as first seen."""
    return stops.filter(F.size("routes") > 0).withColumn("vehicleMode", F.array_distinct(F.transform("routes", lambda r: r["mode"])))


def orphans(stops: DataFrame, stations: DataFrame) -> DataFrame:
    """Platforms whose station is unknown: they are left out of the index, and listed here."""
    platforms = routed(stops).filter("parentStation is not null")
    return platforms.join(stations, platforms["parentStation.gtfsId"] == stations["gtfsId"], "left_anti")


def search_stops(stops: DataFrame, stations: DataFrame, order: str = "ordinal") -> DataFrame:
    """Stops without a station, and stations with the modes and routes of their platforms; with popularity and categories."""
    stops = routed(stops)
    alone = stops.filter("parentStation is null")
    platforms = stops.filter("parentStation is not null").withColumn("_station", F.col("parentStation.gtfsId"))
    rolled = roll_up(platforms, stations.drop(order), "_station", "gtfsId", order, "vehicleMode", "routes")
    poi = union_all(alone.drop(order), rolled)
    categories = F.concat(F.array(*map(F.lit, STOP_CATEGORIES)), prefixed_lower("public_transport:stop:", F.col("vehicleMode")))
    return poi.withColumns({"popularity": popularity(F.col("vehicleMode"), F.size("routes")), "categories": categories})


def stop_rows(poi: DataFrame, source: str, layer: str = "stops") -> DataFrame:
    """Nine columns of an import file."""
    return poi.select(
        F.lit(source).alias("source"), F.lit(layer).alias("layer"), F.col("gtfsId").alias("id"), "name", "lat", "lon", "popularity", F.to_json("categories").alias("categories"), whole_record(*poi.columns).alias("addendum_json_stop")
    )


def place_rows(places: DataFrame, source: str, lat: str, lon: str, names: str, title: str, tags: Column, record: str, prefix: str) -> DataFrame:
    """Twelve columns of an import file. The default name is the Italian one, or null; there is no fallback."""
    name = lambda language: F.col(names)[language][title]
    return places.select(
        F.lit(source).alias("source"),
        F.lit("venue").alias("layer"),
        F.col("Id").alias("id"),
        F.col(lat).alias("lat"),
        F.col(lon).alias("lon"),
        name("it").alias("name"),
        *[name(x).alias(f"name_{x}") for x in ("de", "en", "fr", "it")],
        F.to_json(F.transform(tags, lambda t: slug(prefix, t))).alias("category_json"),
        whole_record(*places.columns).alias(record),
    )


def touristic_rows(places: DataFrame, source: str) -> DataFrame:
    return place_rows(places, source, "GpsPoints.position.Latitude", "GpsPoints.position.Longitude", "Detail", "Title", F.col("Tags.Id"), "addendum_json_poi", "touristic:")


def accommodation_rows(places: DataFrame, source: str) -> DataFrame:
    tags = F.array("AccoType.Id", "AccoCategory.Id")
    return place_rows(places, source, "Latitude", "Longitude", "AccoDetail", "Name", tags, "addendum_json_accomodation", "accomodation:")


def with_operator(stops: DataFrame, operators: DataFrame, value: str = "name", agency: str = "agencyId", order: str = "ordinal") -> DataFrame:
    """Adds `operator`: the first operator that is the agency of the stop's first route, or null."""
    return first_match(stops, operators, F.get("routes", F.lit(0))["agency"]["gtfsId"], agency, order, value, name="operator")


def current_vehicles(measurements: DataFrame, order: str = "ordinal") -> DataFrame:
    """Vehicles with coordinates: the last position and state of each, the rest from its first row.

    Coordinates are text with a decimal comma or point; what is no number stays as null, but the vehicle is listed.
    """
    from ..functions.semantics import decimal_comma
    from ..operators.relate import pivot_last

    wide = pivot_last(measurements, "scode", "tname", "mvalue", order, ["position", "state"], ["sname", "prlineage"])
    at = lambda name: decimal_comma(F.try_variant_get("position", f"$.{name}", "string"))
    state = F.try_variant_get("state", "$", "string")
    return wide.filter("position is not null").select(
        F.col("sname").alias("Name"), state.alias("Address"), F.col("scode").alias("Phone"), F.col("prlineage").alias("Region"), state.alias("State"), at("lat").alias("lat"), at("lon").alias("lon")
    )
