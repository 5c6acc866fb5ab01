"""Rules that decide what a map shows, as columns of feature properties and a zoom level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of icons, sizes, zoom levels, modes and states that consumers of the features know.
STOP_ICONS = {"BUS": "bus-icon", "RAIL": "rail-icon"}
STOP_SIZES = {"BUS": 0.1, "RAIL": 0.15}
STATION_ICONS = {"BUS": "bus-icon", "RAIL": "rail-icon", "BUS,RAIL": "rail-icon", "RAIL,BUS": "rail-icon"}
STATION_SIZES = {"BUS": 0.1, "RAIL,BUS": 0.15, "BUS,RAIL": 0.15, "RAIL": 0.15}
STATION_MIN_ZOOM = {"BUS": 15, "RAIL": 1, "BUS,RAIL": 1, "RAIL,BUS": 1}
STATION_SORT = {"BUS": 10, "RAIL,BUS": 1, "BUS,RAIL": 1, "RAIL": 5}
RENTAL_ICONS = {"BICYCLE": "bicycle-icon", "CAR": "car-icon", "BICYCLE,CAR": "car-icon", "CAR,BICYCLE": "car-icon"}
MODE_ICONS = {
    "bicycle": "Bicycle",
    "bicycle_ride": "BicycleRide",
    "bicycle_rent": "BikeSharing",
    "bicycle_rent_ride": "BikeSharingRide",
    "car_rent": "CarSharing",
    "car_rent_ride": "CarSharingRide",
    "car_park_ride": "ParkRide",
    "micromobility": "Micromobility",
    "micromobility_ride": "MicromobilityRide",
    "transit": "Bus",
    "bus": "Bus",
    "walk": "Walk",
    "gondola": "Funicolar",
    "funicular": "Funicolar",
    "rail": "Rail",
    "car": "Car",
    "car_rental": "CarSharing",
    "park_ride": "ParkRide",
}
STOP_SOURCE = "otp"
COMPANY_MODES = ["CAR_RENT", "CAR_HAIL", "MICROMOBILITY_RENT", "SCOOTER"]
CHARGER_MIN_ZOOM = 10


def match(c: Column, arms: dict, default) -> Column:
    """The value of the arm that equals c, or the default."""
    out = F
    for key, value in arms.items():
        out = out.when(c == key, F.lit(value))
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def step(zoom: Column, first: Column, *stops: tuple[float, Column]) -> Column:
    """first below the first stop, then the value of the last stop reached."""
    out = F
    for level, value in reversed(stops):
        out = out.when(zoom >= level, value)
    return out.otherwise(first)


def has_routes(routes: Column) -> Column:
    """Routes are JSON text: there, not an empty array, not empty."""
    return F.coalesce((routes != "[]") & (F.length(routes) > 0), F.lit(False))


def live_dot_shown(live: Column) -> Column:
    """A stop with real-time data has a dot."""
    return F.coalesce(live, F.lit(False))


def highlighted(parent: Column, wanted: Column, routes: Column) -> Column:
    """Platforms of the highlighted station, which may be none, if they have routes."""
    return parent.eqNullSafe(wanted) & has_routes(routes)


def platform_shown(platform: Column, routes: Column) -> Column:
    return platform.isNotNull() & has_routes(routes)


def layer_types(overlays: Column, kind: str = "otp2") -> Column:
    """Types of the layers of all overlays of a kind, in their order; overlays without layers add none."""
    mine = F.filter(F.coalesce(overlays, F.array().cast("array<struct<type:string,layers:array<struct<type:string>>>>")), lambda o: o["type"] == kind)
    return F.flatten(F.transform(mine, lambda o: F.coalesce(F.transform(o["layers"], lambda x: x["type"]), F.array().cast("array<string>"))))


def tile_url(endpoint: Column, types: Column) -> Column:
    return F.concat(endpoint, F.lit("/"), F.array_join(types, ","), F.lit("/tilejson.json"))


def branded(host: Column, brands: dict[str, dict[str, str]], field: str, default: Column) -> Column:
    """A host's own branding or title; that of the settings for any other host. A brand that lacks it has none."""
    return match(host, {h: b.get(field) for h, b in brands.items()}, default)


def tagged(tags: Column, wanted: dict[str, list[str]]) -> Column:
    """Whether any of the named tags has one of the values listed for it."""
    tests = [F.coalesce(F.try_element_at(tags, F.lit(k)).isin(v), F.lit(False)) for k, v in wanted.items()]
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out


def shown_at_zoom(kind: Column, zoom: Column) -> Column:
    return zoom >= match(kind, STATION_MIN_ZOOM, 15)


def stop_label(zoom: Column, name: Column, platform: Column) -> Column:
    return step(zoom, name, (16, F.lit("")), (17, platform))


def station_label(zoom: Column, kind: Column, name: Column, platform: Column) -> Column:
    return step(zoom, match(kind, {"BUS": ""}, F.when(kind.isin("RAIL,BUS", "BUS,RAIL"), name).otherwise("")), (16, platform))


def name_label(zoom: Column, name: Column) -> Column:
    return step(zoom, F.lit(""), (17, name))


def rental_icon(form_factors: Column, operative: Column, vehicles: Column) -> Column:
    """Available, unavailable or plain icon; plain only where it is not known whether the station operates and vehicles are left."""
    base = match(form_factors, RENTAL_ICONS, "bicycle-icon")
    left = F.coalesce(vehicles, F.lit(0)) > 0
    return (
        F.when(F.coalesce(operative, F.lit(False)) & left, F.concat(base, F.lit("-available")))
        .when(F.coalesce(~operative, F.lit(False)) | ~left, F.concat(base, F.lit("-unavailable")))
        .otherwise(base)
    )


def rental_shown(form_factors: Column) -> Column:
    return ~form_factors.eqNullSafe(F.lit(""))


def rental_unit(form_factors: Column) -> Column:
    """What a rental station counts: bikes, cars or vehicles."""
    kinds = F.split(form_factors, ",")
    bike, car = F.array_contains(kinds, "BICYCLE"), F.array_contains(kinds, "CAR")
    return F.when(bike & ~car, "bikes").when(car & ~bike, "cars").otherwise("vehicles")


def parking_icon(car_places: Column, bicycle_places: Column) -> Column:
    some = (F.coalesce(car_places, F.lit(0)) > 0) | (F.coalesce(bicycle_places, F.lit(0)) > 0)
    return F.when(some, "parking-available-icon").otherwise("parking-unavailable-icon")


def opacity(dimmed: Column) -> Column:
    return F.when(F.coalesce(dimmed, F.lit(False)), 0.3).otherwise(1.0)


def taxi_opacity(state: Column) -> Column:
    return opacity(state == "OCCUPIED")


def charger_opacity(free: Column) -> Column:
    return F.when(F.coalesce(free > 0, F.lit(False)), 1.0).otherwise(0.3)


def charger_shown(free: Column, zoom: Column) -> Column:
    return F.coalesce(free > 0, F.lit(False)) | (zoom >= CHARGER_MIN_ZOOM)


def mode_icon(mode: Column) -> Column:
    """The icon of a mode, in any case; null for an unknown mode."""
    return match(F.lower(mode), MODE_ICONS, F.lit(None).cast("string"))


def known_types(types: Column, codes: Column) -> Column:
    """Whether a charger is shown: no type is unknown, and, if it has no types, not all of its plugs are unknown."""
    unknown = lambda t: F.lower(F.coalesce(t, F.lit(""))).isin("unknown", "undefined")
    none = F.size(F.coalesce(types, F.array().cast("array<string>"))) == 0
    nameless = lambda t: (F.coalesce(t, F.lit("")) == "") | unknown(t)
    every = F.coalesce((F.size(codes) > 0) & F.forall(codes, nameless), F.lit(False))
    return ~(F.coalesce(F.exists(types, unknown), F.lit(False)) | (none & every))


def nearby_shown(kind: Column, departures: Column, allowed: list[str] | None) -> Column:
    """Of an allowed kind (or no list is given), and with departures if it is a stop."""
    fits = F.lit(True) if allowed is None else F.coalesce(kind.isin(allowed), F.lit(False))
    return fits & (~kind.eqNullSafe(F.lit("Stop")) | F.coalesce(departures > 0, F.lit(False)))


def fresh(asked_lat: Column, asked_lon: Column, lat: Column, lon: Column) -> Column:
    """Whether results are those of the coordinates asked for."""
    return asked_lat.eqNullSafe(lat) & asked_lon.eqNullSafe(lon)


def nearby_point(url: Column, position: Column, flat: Column, centre: Column, default: Column) -> Column:
    """The first point there is, of structs (lat, lon); the flat position counts only if neither part is 0 or null."""
    usable = F.coalesce((flat["lat"] != 0) & (flat["lon"] != 0), F.lit(False))
    return F.coalesce(url, position, F.when(usable, flat), centre, default)


def place_location(lat: Column, lon: Column, coordinates: Column, name: Column, property_name: Column) -> Column:
    """A place's own fields, or those of its geometry [lon, lat] and properties."""
    return F.struct(
        F.coalesce(lat, F.get(coordinates, F.lit(1))).alias("lat"), F.coalesce(lon, F.get(coordinates, F.lit(0))).alias("lon"), F.coalesce(name, property_name).alias("name")
    )


def poi_shape(has_properties: Column, source: Column, raw: Column, stop: Column, feature: Column) -> Column:
    """Which of three shapes a geocoded place has: itself, its stop, or its properties with coordinates."""
    return F.when(~has_properties, raw).when(source == STOP_SOURCE, stop).otherwise(feature)


def removed(old: Column, new: Column) -> Column:
    """Items of old that are not in new, repeats and order kept."""
    return F.filter(old, lambda m: ~F.array_contains(new, m))


def overlay_change(mode: Column, company: Column, old_modes: Column, new_modes: Column, old_companies: Column, new_companies: Column) -> Column:
    """Whether an overlay of one mode becomes visible (true), hidden (false) or stays as it is (null)."""
    was, now = F.array_contains(old_modes, mode), F.array_contains(new_modes, mode)
    active = F.coalesce(F.array_contains(F.split(new_companies, ","), company), F.lit(False))
    by_company = (
        F.when(now & ~was, F.when(active, True))
        .when(was & ~now, False)
        .when(now & ~old_companies.eqNullSafe(new_companies), active)
    )
    plain = F.when(now & ~was, True).when(was & ~now, False)
    return F.when(mode.isin(COMPANY_MODES) & company.isNotNull(), by_company).otherwise(plain)


def by_priority(df: DataFrame, kind: str) -> DataFrame:
    """Features in the order in which they are drawn."""
    return df.orderBy(match(F.col(kind), STATION_SORT, 10))
