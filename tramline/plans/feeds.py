"""Availability feeds of shared vehicles and charging stations, from snapshots of entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..functions import semantics as S
from ..operators.facets import facets
from ..operators.relate import count_children, first_match, nest_children

# Fixed values of the feeds: contexts with their origins, regions and system names; versions; vehicle types.
VERSION = 2.1
CONTEXTS = ("bz", "me", "papin")
ORIGINS = {"bz": "BIKE_SHARING_BOLZANO", "papin": "BIKE_SHARING_PAPIN"}
REGIONS = [("BZ", "Bolzano - Bozen"), ("ME", "Merano - Meran"), ("PAPIN", "Papin - Rent a bike")]
SYSTEMS = {"bz": ("odh_bikesharing_bz", "Bikesharing  Bolzano"), "me": ("odh_bikesharing_me", "Bikesharing  Merano"), "papin": ("odh_bikesharing_papin", "Bikesharing  Papin")}
VEHICLE_TYPES = [("bike", "bicycle", "human", "Bicycle", None), ("e-bike", "bicycle", "electric_assist", "E-Bike", 20000)]
FEEDS = ["system_information", "station_information", "station_status", "system_regions", "system_hours"]
LATER_FEEDS = ["gbfs_versions", "vehicle_types"]
DAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
UNKNOWN = "unknown"
FACET_LABELS = {"provider": "label_provider", "accessType": "label_accesstype", "reservable": "label_reservable", "state": "label_state", "plugsTypes": "label_plugs_types"}


def check_request(context: str, version: float = 1, later_only: bool = False) -> None:
    """Refuses an unknown context or version. Feeds that exist in the later version only refuse just what is below it."""
    if (version < VERSION) if later_only else version not in (1, VERSION):
        raise ValueError("wrong version")
    if context not in CONTEXTS:
        raise ValueError("wrong context")


def eligible(origin: str) -> Column:
    """Stations of an origin that are active and available."""
    return (F.col("sorigin") == origin) & S.truthy(F.col("sactive")) & S.truthy(F.col("savailable"))


def described() -> Column:
    """Stations with coordinates and metadata, which information needs and status does not."""
    return F.col("scoordinate").isNotNull() & S.truthy_variant(F.col("smetadata"))


def station_information(stations: DataFrame) -> DataFrame:
    """Stations of the first city: a capacity of 0, or none, is null."""
    rows = stations.filter(eligible(ORIGINS["bz"]) & described())
    capacity = S.field(F.col("smetadata"), "total-bays")
    return rows.select(
        F.col("scode").alias("station_id"),
        F.col("sname").alias("name"),
        F.col("scoordinate.y").alias("lat"),
        F.col("scoordinate.x").alias("lon"),
        S.get(F.col("smetadata"), "address", "string").alias("address"),
        F.lit("BZ").alias("region_id"),
        S.or_null(S.to_number(capacity)).cast("bigint").alias("capacity"),
    )


def rental_station_information(stations: DataFrame) -> DataFrame:
    """Stations of the third context: without the prefix of their ids, with opening hours or null."""
    text = lambda name: S.get(F.col("smetadata"), name, "string")
    return stations.filter(eligible(ORIGINS["papin"]) & described()).select(
        S.replace_first(F.col("scode"), ORIGINS["papin"] + ":", "").alias("station_id"),
        F.col("sname").alias("name"),
        F.col("scoordinate.y").alias("lat"),
        F.col("scoordinate.x").alias("lon"),
        F.lit("PAPIN").alias("region_id"),
        S.opening_hours(text("startHour"), text("endHour"), text("lunchBreakStart"), text("lunchBreakEnd")).alias("station_opening_hours"),
    )


def virtual_station_information(dimension: DataFrame) -> DataFrame:
    """Drop-off areas of the second city, from a dimension of text columns."""
    return dimension.select(
        F.col("id").alias("station_id"),
        S.replace_first(F.col("name"), "_", "/").alias("name"),
        S.decimal_point(F.col("lat")).alias("lat"),
        S.decimal_point(F.col("lng")).alias("lon"),
        F.col("full_address").alias("address"),
        F.lit("ME").alias("region_id"),
        F.lit(True).alias("is_virtual_station"),
        F.struct(F.lit("MultiPolygon").alias("type"), geo.multi_polygon(F.col("polygon")).alias("coordinates")).alias("station_area"),
    )


def station_status(stations: DataFrame, bays: DataFrame, bikes: DataFrame, last_updated: int) -> DataFrame:
    """Docks and bikes of the first city's stations.

    Where the metadata have a bikes entry its count is taken, and docks are 0. Else bays and bikes are counted, each
    hop before its join: docks are the total less disabled bays less available bikes, at least 0, so a disabled bay
    with an available bike counts twice. Without a total, docks are null. Stations whose count of bikes is absent or
    negative are left out; a count of null stays. Counted stations also give the docks, which take any type, and the bikes by type.
    """
    meta, own = F.col("smetadata"), S.field(F.col("smetadata"), "bikes")
    free, electric = S.truthy(F.col("savailable")), S.truthy_variant(S.field(F.col("smetadata"), "electric"))
    per_bay = count_children(bays, bikes, "scode", "pcode", n_bikes=F.count_if(free), n_electric=F.count_if(free & electric))
    rows = count_children(
        stations.filter(eligible(ORIGINS["bz"])), per_bay, "scode", "pcode", disabled=F.count_if(~S.truthy(F.col("savailable"))), bikes=F.sum("n_bikes"), electric=F.sum("n_electric")
    )
    counted = ~S.truthy_variant(own)
    number = F.try_variant_get(own, "$['number-available']", "variant")
    docks = S.to_number(S.field(meta, "total-bays")) - F.col("disabled") - F.col("bikes")
    docks = F.when(docks.isNotNull() & ~F.isnan(docks), F.greatest(F.lit(0), docks)).cast("bigint")
    rows = rows.filter(counted | (number.isNotNull() & (F.is_variant_null(number) | (S.to_number(number) >= 0))))
    only = lambda c: F.when(counted, c)
    kinds = [t[0] for t in VEHICLE_TYPES]
    return rows.select(
        S.or_else(F.col("scode"), F.lit(UNKNOWN), "string").alias("station_id"),
        F.lit(True).alias("is_renting"),
        F.lit(True).alias("is_installed"),
        F.lit(True).alias("is_returning"),
        F.when(counted, docks).otherwise(0).alias("num_docks_available"),
        F.when(counted, F.col("bikes")).otherwise(F.try_variant_get(number, "$", "bigint")).alias("num_bikes_available"),
        only(F.col("disabled")).alias("num_docks_disabled"),
        only(F.array(F.struct(F.array(*map(F.lit, kinds)).alias("vehicle_type_ids"), docks.alias("count")))).alias("vehicle_docks_available"),
        only(F.array(*[F.struct(F.lit(kind).alias("vehicle_type_id"), n.alias("count")) for kind, n in zip(kinds, (F.col("bikes") - F.col("electric"), F.col("electric")))])).alias("vehicle_types_available"),
        F.lit(last_updated).cast("bigint").alias("last_reported"),
    )


def rental_station_status(stations: DataFrame, last_updated: int) -> DataFrame:
    """The third context counts nothing: 100 bikes and 100 docks."""
    return stations.filter(eligible(ORIGINS["papin"])).select(
        S.replace_first(F.col("scode"), ORIGINS["papin"] + ":", "").alias("station_id"), *_constants(True, True, 100, 100, last_updated)
    )


def virtual_station_status(dimension: DataFrame, last_updated: int) -> DataFrame:
    """Drop-off areas hold no bikes and take 1000; they are neither installed nor renting."""
    return dimension.select(S.or_else(F.col("id"), F.lit(UNKNOWN), "string").alias("station_id"), *_constants(False, False, 1000, 0, last_updated))


def _constants(renting: bool, installed: bool, docks: int, bikes: int, last_updated: int) -> list[Column]:
    return [
        F.lit(renting).alias("is_renting"),
        F.lit(installed).alias("is_installed"),
        F.lit(True).alias("is_returning"),
        F.lit(docks).cast("bigint").alias("num_docks_available"),
        F.lit(bikes).cast("bigint").alias("num_bikes_available"),
        F.lit(last_updated).cast("bigint").alias("last_reported"),
    ]


def free_bike_status(bikes: DataFrame, dimension: DataFrame, order: str = "ordinal") -> DataFrame:
    """Active bikes without a parent, of whatever origin; the station is the first area of the parking's name."""
    meta = F.col("smetadata")
    loose = bikes.filter(~S.truthy(F.col("pcode"), "string") & S.truthy(F.col("sactive")))
    named = first_match(loose, dimension, S.get(meta, "location_parking_name", "string"), "name", order, "id", UNKNOWN, "station_id")
    return named.select(
        F.col("scode").alias("bike_id"),
        F.col("scoordinate.y").alias("lat"),
        F.col("scoordinate.x").alias("lon"),
        S.loosely_equals(S.field(meta, "future-availability"), 0).alias("is_reserved"),
        S.loosely_equals(S.field(meta, "in-maintenance"), 1).alias("is_disabled"),
        F.lit("bike").alias("vehicle_type_id"),
        "station_id",
    )


_PLUG_FIELDS = "maxPower: double, maxCurrent: double, minCurrent: double, outletTypeCode: variant"


def plugs_of(plugs: DataFrame) -> DataFrame:
    """Plugs with metadata as records: of the first outlet if there are outlets, else of the plug itself."""
    whole = F.try_variant_get("smetadata", "$", f"struct<outlets: array<variant>, {_PLUG_FIELDS}>")
    rows = plugs.filter(S.truthy_variant(F.col("smetadata"))).withColumn("_own", whole)
    first = F.try_variant_get(F.get("_own.outlets", F.lit(0)), "$", f"struct<{_PLUG_FIELDS}>")
    own = F.struct(*[F.col(f"_own.{n}").alias(n) for n in ("maxPower", "maxCurrent", "minCurrent", "outletTypeCode")])
    rows = rows.withColumn("_of", F.when(F.coalesce(F.size("_own.outlets") > 0, F.lit(False)), first).otherwise(own))
    return rows.select(
        "pcode",
        "ordinal",
        F.col("scode").alias("plug_id"),
        F.col("sname").alias("name"),
        S.strictly_equals(F.col("mvalue"), 1).alias("available"),
        *[F.col(f"_of.{n}").alias(n) for n in ("maxPower", "maxCurrent", "minCurrent")],
        F.try_variant_get("_of.outletTypeCode", "$", "string").alias("outletTypeCode"),
        S.key_text(F.col("_of.outletTypeCode")).alias("type_key"),
    )


def charger_stations(stations: DataFrame, plugs: DataFrame, bbox: str | None = None) -> DataFrame:
    """Active stations with coordinates and metadata, in the box, with their plugs nested."""
    meta, text = F.col("smetadata"), lambda name: S.get(F.col("smetadata"), name, "string")
    rows = stations.filter(S.truthy(F.col("sactive")) & described() & geo.in_bbox(F.col("scoordinate.x"), F.col("scoordinate.y"), geo.parse_bbox(bbox)))
    fields = ["plug_id", "name", "available", "maxPower", "maxCurrent", "minCurrent", "outletTypeCode", "type_key"]
    wanted = plugs.join(rows.select(F.col("scode").alias("pcode")).hint("merge"), "pcode", "left_semi")  # others are not worth opening their metadata
    rows = nest_children(rows, plugs_of(wanted), "scode", "pcode", "ordinal", fields, "plugs")
    return rows.select(
        F.col("scode").alias("station_id"),
        F.col("sname").alias("name"),
        F.col("scoordinate.y").alias("lat"),
        F.col("scoordinate.x").alias("lon"),
        text("address").alias("address"),
        S.title_words(S.or_else(text("municipality"), text("city"), "string")).alias("city"),
        text("accessType").alias("accessType"),
        S.or_else(S.to_number(S.field(meta, "capacity")).cast("bigint"), F.size("plugs").cast("bigint")).alias("capacity"),
        F.size(F.filter("plugs", lambda p: p["available"])).cast("bigint").alias("free"),
        S.trimmed_or_empty(text("provider")).alias("provider"),
        S.yes_no(S.truthy_variant(S.field(meta, "reservable"))).alias("reservable"),
        text("state").alias("state"),
        S.first_seen_keys(F.transform("plugs", lambda p: p["type_key"])).alias("plugsTypes"),
        F.transform("plugs", lambda p: p.dropFields("type_key")).alias("plugs"),
    )


def charger_facets(stations: DataFrame, plugs: DataFrame) -> DataFrame:
    """Distinct providers, access types, reservability, states and plug types, of inactive stations too."""
    meta, text = F.col("smetadata"), lambda name: S.key_text(S.field(F.col("smetadata"), name))
    rows = stations.select(
        S.trimmed_or_empty(S.get(meta, "provider", "string")).alias("provider"),
        text("accessType").alias("accessType"),
        S.yes_no(S.truthy_variant(S.field(meta, "reservable"))).alias("reservable"),
        text("state").alias("state"),
    )
    known = stations.select(F.col("scode").alias("pcode")).hint("merge")  # as many as there are stations, whatever the estimate says
    types = plugs_of(plugs).select("pcode", "type_key").join(known, "pcode", "left_semi").select(F.lit("plugsTypes").alias("facet"), F.col("type_key").alias("value"))
    return facets(rows, rows.columns).union(types.distinct())


def feed_list(spark: SparkSession, context: str, version: float, base_url: str) -> DataFrame:
    """The feeds that exist in a context and version."""
    check_request(context, version)
    names = FEEDS + (LATER_FEEDS if version >= VERSION else []) + (["free_bike_status"] if context == "me" else [])
    return spark.createDataFrame([(n, f"{base_url}/{context}/{version:g}/{n}.json") for n in names], "name string, url string")


def base_url(headers: dict[str, str], protocol: str = "http", sees_port: bool = True) -> str:
    """Protocol and host as a proxy's headers have them; port 443 makes it https, but not in the list of versions."""
    host = headers.get("x-forward-host") or headers.get("x-forwarded-host") or headers["host"]
    protocol = headers.get("x-forward-proto") or headers.get("x-forwarded-proto") or protocol
    return ("https" if sees_port and ":443" in host else protocol) + "://" + host


def versions(spark: SparkSession, context: str, version: float, base: str) -> DataFrame:
    check_request(context, version, later_only=True)
    return spark.createDataFrame([(v, f"{base}/{context}/{p}/gbfs.json") for v, p in (("1.0", "1"), (f"{VERSION}", f"{VERSION}"))], "version string, url string")


def regions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REGIONS, "region_id string, name string")


def vehicle_types(spark: SparkSession, context: str, version: float = VERSION) -> DataFrame:
    check_request(context, version, later_only=True)
    return spark.createDataFrame(VEHICLE_TYPES, "vehicle_type_id string, form_factor string, propulsion_type string, name string, max_range_meters int")


def system_information(spark: SparkSession, context: str, version: float = 1, web: str | None = None, android: str | None = None, ios: str | None = None) -> DataFrame:
    """Name and addresses of a system. If there are apps for both platforms, only the second is listed."""
    check_request(context, version)
    ident, name = SYSTEMS[context]
    app = ("ios", ios) if ios else ("android", android) if android else (None, None)
    return spark.createDataFrame(
        [(ident, "it", name, "Europe/Rome", web or "", web or "", *app)], "system_id string, language string, name string, timezone string, url string, purchase_url string, app_platform string, app_store_uri string"
    )


def system_hours(spark: SparkSession, context: str, version: float = 1) -> DataFrame:
    """Hours of the two cities; the third context has none."""
    check_request(context, version)
    rows = [(["member", "nonmember"], DAYS, "00:00:00", "23:59:59")] if context in ("me", "bz") else []
    return spark.createDataFrame(rows, "user_types array<string>, days array<string>, start_time string, end_time string")
