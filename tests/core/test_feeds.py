"""Feeds over hand-made snapshots."""

import json

import pytest
from pyspark.sql import functions as F

from tramline.plans import feeds
from tramline.sources import documents, sinks, snapshots

BZ, PAPIN = feeds.ORIGINS["bz"], feeds.ORIGINS["papin"]


def load(spark, tmp_path, name, rows, schema):
    path = tmp_path / f"{name}.json"
    path.write_text(json.dumps({"data": rows}))
    return snapshots.read_envelope(spark, str(path), schema)


def station(code, meta=None, origin=BZ, **more):
    return {"scode": code, "sname": f"S {code}", "sorigin": origin, "sactive": True, "savailable": True, "scoordinate": {"x": 11.0, "y": 46.0}, "smetadata": meta if meta is not None else {}} | more


@pytest.fixture
def city(spark, tmp_path):
    stations = [
        station("a", {"address": "x", "total-bays": 10}),
        station("b", {"total-bays": "4"}),
        station("c", {}),
        station("d", {"bikes": {"number-available": 5}, "total-bays": 0}),
        station("e", {"bikes": {"number-available": None}}),
        station("f", {"bikes": {}}),
        station("g", {"bikes": {"number-available": -1}}),
        station("h", {"total-bays": 3}, sactive=False),
        station("i", {"total-bays": 3}, savailable=False),
        station("j", {"total-bays": 1}, scoordinate=None),
        station("k", {"total-bays": 9}, origin="ELSE"),
    ]
    bays = [{"scode": "a1", "pcode": "a", "savailable": True}, {"scode": "a2", "pcode": "a", "savailable": False}, {"scode": "a3", "pcode": "a", "savailable": False}, {"scode": "j1", "pcode": "j", "savailable": False}]
    bikes = [
        {"pcode": "a1", "savailable": True, "smetadata": {"electric": True}},
        {"pcode": "a2", "savailable": True, "smetadata": {"electric": False}},  # in a disabled bay: takes two docks
        {"pcode": "a1", "savailable": False},
        {"pcode": "j1", "savailable": True},
    ]
    return load(spark, tmp_path, "stations", stations, snapshots.STATION), load(spark, tmp_path, "bays", bays, snapshots.BAY), load(spark, tmp_path, "bikes", bikes, snapshots.BIKE)


def test_station_status(city):
    rows = {r["station_id"]: r for r in feeds.station_status(*city, 99).collect()}
    assert set(rows) == {"a", "b", "c", "d", "e", "j"}
    pick = lambda r: (r["num_docks_available"], r["num_bikes_available"], r["num_docks_disabled"], *([t["count"] for t in r["vehicle_types_available"]] if r["vehicle_types_available"] else (None, None)))
    assert pick(rows["a"]) == (6, 2, 2, 1, 1)
    assert pick(rows["b"]) == (4, 0, 0, 0, 0)
    assert pick(rows["c"]) == (None, 0, 0, 0, 0)
    assert pick(rows["d"]) == (0, 5, None, None, None)
    assert pick(rows["e"]) == (0, None, None, None, None)
    assert pick(rows["j"]) == (0, 1, 1, 1, 0)  # never below zero


def test_station_information(city):
    rows = {r["station_id"]: (r["capacity"], r["address"], r["lat"]) for r in feeds.station_information(city[0]).collect()}
    assert rows == {"a": (10, "x", 46.0), "b": (4, None, 46.0), "c": (None, None, 46.0), "d": (None, None, 46.0), "e": (None, None, 46.0), "f": (None, None, 46.0), "g": (None, None, 46.0)}


def test_rental_context(spark, tmp_path):
    rows = [station(f"{PAPIN}:1", {"startHour": "08:00", "endHour": "18:00", "lunchBreakStart": ""}, origin=PAPIN), station("2", {"startHour": "8"}, origin=PAPIN)]
    stations = load(spark, tmp_path, "p", rows, snapshots.STATION)
    assert {(r["station_id"], r["station_opening_hours"]) for r in feeds.rental_station_information(stations).collect()} == {("1", "Mo-Su 08:00-18:00"), ("2", None)}
    assert {(r["station_id"], r["num_bikes_available"]) for r in feeds.rental_station_status(stations, 1).collect()} == {("1", 100), ("2", 100)}


def test_virtual_stations_and_free_bikes(spark, tmp_path):
    path = tmp_path / "areas.csv"
    path.write_text('id,name,lat,lng,full_address,polygon\n7,A_B_C,46.5,11.25,"Street 1, Town","(46.1,11.1), (46.2,11.2), (46.1,11.1)"\n8,A_B_C,46.6,11.3,,"(1,2), (3,4), (1,2)"\n')
    areas = snapshots.read_dimension(spark, str(path)).withColumn("ordinal", F.col("id").cast("int"))
    info = {r["station_id"]: r for r in feeds.virtual_station_information(areas).collect()}
    assert info["7"]["name"] == "A/B_C" and info["7"]["lon"] == 11.25 and info["7"]["address"] == "Street 1, Town" and info["8"]["address"] == ""
    assert info["7"]["station_area"]["coordinates"] == [[[[11.1, 46.1], [11.2, 46.2], [11.1, 46.1]]]]
    xy = {"x": 1.0, "y": 2.0}
    bikes = [
        {"scode": "1", "sactive": True, "scoordinate": xy, "smetadata": {"location_parking_name": "A_B_C", "future-availability": 0, "in-maintenance": "1"}},
        {"scode": "2", "pcode": "", "sactive": True, "scoordinate": xy, "smetadata": {"future-availability": None, "in-maintenance": None}},
        {"scode": "3", "pcode": "7", "sactive": True, "scoordinate": xy, "smetadata": {}},
        {"scode": "4", "sactive": False, "scoordinate": xy, "smetadata": {}},
    ]
    out = {r["bike_id"]: (r["station_id"], r["is_reserved"], r["is_disabled"]) for r in feeds.free_bike_status(load(spark, tmp_path, "bikes", bikes, snapshots.BIKE), areas).collect()}
    assert out == {"1": ("7", True, True), "2": ("unknown", False, False)}


@pytest.fixture
def charging(spark, tmp_path):
    stations = [
        station("s", {"municipality": "", "city": "SANKT neu-MARKT", "capacity": 0, "provider": "\t P \n", "reservable": True, "state": "ACTIVE", "accessType": "PUBLIC"}),
        station("t", {"municipality": "Bozen", "capacity": 4, "state": None}),
        station("u", {"provider": "Q"}, sactive=False),
    ]
    plugs = [
        {"scode": "s1", "pcode": "s", "sname": "1", "mvalue": 1, "smetadata": {"outlets": [{"outletTypeCode": "T2", "maxPower": 22}, {"outletTypeCode": "X"}]}},
        {"scode": "s2", "pcode": "s", "sname": "2", "mvalue": "1", "smetadata": {"outlets": [], "outletTypeCode": "CCS"}},
        {"scode": "s3", "pcode": "s", "sname": "3", "mvalue": None, "smetadata": {"outlets": [{"outletTypeCode": None}], "outletTypeCode": "CCS"}},
        {"scode": "s4", "pcode": "s", "sname": "4", "mvalue": 0, "smetadata": {"maxPower": 3}},
        {"scode": "s5", "pcode": "s", "sname": "5", "mvalue": 1},
        {"scode": "u1", "pcode": "u", "sname": "6", "mvalue": 1, "smetadata": {"outletTypeCode": "OLD"}},
    ]
    return load(spark, tmp_path, "chargers", stations, snapshots.STATION), load(spark, tmp_path, "plugs", plugs, snapshots.PLUG)


def test_charger_stations(charging):
    rows = {r["station_id"]: r for r in feeds.charger_stations(*charging).collect()}
    s = rows["s"]
    assert set(rows) == {"s", "t"} and (s["city"], s["capacity"], s["free"], s["provider"], s["reservable"]) == ("Sankt Neu-markt", 4, 1, "P", "yes")
    assert s["plugsTypes"] == ["T2", "CCS", "null", "undefined"] and [p["outletTypeCode"] for p in s["plugs"]] == ["T2", "CCS", None, None]
    assert (rows["t"]["plugs"], rows["t"]["capacity"], rows["t"]["provider"]) == ([], 4, "")
    assert feeds.charger_stations(*charging, "11,46,12,47").count() == 2 and feeds.charger_stations(*charging, "11.1,46,12,47").count() == 0


def test_charger_facets_have_inactive_stations(charging):
    rows = feeds.charger_facets(*charging)
    found = {(r["facet"], r["value"]) for r in rows.collect()}
    assert {("provider", "Q"), ("provider", ""), ("plugsTypes", "OLD"), ("state", "null"), ("state", "undefined"), ("reservable", "no")} <= found
    from tramline.operators.facets import facet_document

    text = sinks.to_yaml(facet_document(rows, feeds.FACET_LABELS))
    assert text.startswith("filters:\n  provider:\n    enabled: true\n    label: label_provider\n    values:\n      - value: ''\n        enabled: true\n")


def test_catalogues(spark):
    names = lambda c, ver: [r["name"] for r in feeds.feed_list(spark, c, ver, "http://h").collect()]
    assert len(names("bz", 1)) == 5 and len(names("bz", 2.1)) == 7 and names("me", 2.1)[-1] == "free_bike_status"
    assert feeds.feed_list(spark, "bz", 2.1, "http://h").first()["url"] == "http://h/bz/2.1/system_information.json"
    for context, version in (("xx", 1), ("bz", 3)):
        with pytest.raises(ValueError):
            feeds.feed_list(spark, context, version, "")
    with pytest.raises(ValueError):
        feeds.versions(spark, "bz", 1, "")
    assert feeds.versions(spark, "bz", 3, "b").count() == 2
    assert feeds.vehicle_types(spark, "bz").count() == 2 and feeds.regions(spark).count() == 3
    app = feeds.system_information(spark, "me", android="a", ios="i").first()
    assert (app["app_platform"], app["app_store_uri"], app["name"]) == ("ios", "i", "Bikesharing  Merano")
    assert feeds.system_hours(spark, "papin").count() == 0 and feeds.system_hours(spark, "bz").count() == 1
    assert feeds.base_url({"host": "h:443"}) == "https://h:443" and feeds.base_url({"host": "h:443"}, sees_port=False) == "http://h:443"
    assert feeds.base_url({"host": "h", "x-forwarded-host": "o", "x-forwarded-proto": "https"}) == "https://o"


def test_envelope(city, tmp_path):
    status = feeds.station_status(*city, 99).filter("station_id in ('a', 'c')")
    path = str(tmp_path / "status.json")
    documents.write_envelope(status, path, "stations", 99, "2.1", order="station_id", keep_nulls=["num_docks_available"])
    doc = json.loads(open(path).read())
    assert (doc["last_updated"], doc["ttl"], doc["version"]) == (99, 0, "2.1") and len(doc["data"]["stations"]) == 2
    assert doc["data"]["stations"][1]["num_docks_available"] is None and doc["data"]["stations"][0]["num_docks_available"] == 6
    assert doc["data"]["stations"][0]["vehicle_docks_available"] == [{"vehicle_type_ids": ["bike", "e-bike"], "count": 6}]
    assert doc["data"]["stations"][0]["vehicle_types_available"] == [{"vehicle_type_id": "bike", "count": 1}, {"vehicle_type_id": "e-bike", "count": 1}]
