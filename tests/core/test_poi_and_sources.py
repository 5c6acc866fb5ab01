"""Stops and places, readers, writers, streams."""

import http.server
import json
import threading

from pyspark.sql import functions as F

from tramline import config
from tramline.operators import relate
from tramline.plans import poi
from tramline.sources import catalogue, rest, sinks, snapshots
from tramline.streaming import snapshots as streams


def route(i, mode):
    return {"gtfsId": i, "mode": mode, "agency": {"gtfsId": "ag"}}


def graph(tmp_path):
    stops = [
        {"gtfsId": "1", "name": "alone", "routes": [route("r1", "BUS"), route("r2", "BUS"), route("r3", "FERRY")]},
        {"gtfsId": "2", "name": "none", "routes": []},
        {"gtfsId": "3", "name": "p1", "parentStation": {"gtfsId": "S"}, "routes": [route("r1", "RAIL")]},
        {"gtfsId": "4", "name": "p2", "parentStation": {"gtfsId": "S"}, "routes": [route("r1", "RAIL"), route("r4", "BUS")]},
        {"gtfsId": "5", "name": "lost", "parentStation": {"gtfsId": "?"}, "routes": [route("r1", "RAIL")]},
    ]
    path = tmp_path / "graph.json"
    path.write_text(json.dumps({"data": {"stops": stops, "stations": [{"gtfsId": "S", "name": "Station", "lat": 46.0, "lon": 11.0}, {"gtfsId": "T", "name": "bare"}]}}))
    return str(path)


def test_search_stops(spark, tmp_path):
    tables = snapshots.read_collections(spark, graph(tmp_path), {"stops": snapshots.STOP, "stations": snapshots.PLACE, "vehicleParkings": "name string"})
    assert tables["vehicleParkings"].count() == 0
    rows = {r["gtfsId"]: r for r in poi.search_stops(tables["stops"], tables["stations"]).collect()}
    assert set(rows) == {"1", "S"}
    assert rows["1"]["popularity"] == 500 + 750 and rows["1"]["categories"] == ["public_transport", "public_transport:stop", "public_transport:stop:bus", "public_transport:stop:ferry"]
    assert rows["S"]["popularity"] == 1500 + 750 and rows["S"]["vehicleMode"] == ["RAIL", "BUS"] and len(rows["S"]["routes"]) == 3  # repeats count
    assert [r["name"] for r in poi.orphans(tables["stops"], tables["stations"]).collect()] == ["lost"]
    out = poi.stop_rows(poi.search_stops(tables["stops"], tables["stations"]), "src")
    assert len(out.columns) == 9 and json.loads(out.filter("id = 'S'").first()["addendum_json_stop"])["code"] is None


def test_places_and_csv(spark, tmp_path):
    item = "Id string, GpsPoints struct<position:struct<Latitude:double,Longitude:double>>, Detail map<string,struct<Title:string>>, Tags array<struct<Id:string>>"
    items = [
        {"Id": "a", "GpsPoints": {"position": {"Latitude": 46.5, "Longitude": 11.0}}, "Detail": {"it": {"Title": 'Al "Bar", uno'}, "de": {"Title": "Zur\nPost"}}, "Tags": [{"Id": "eating out"}, {"Id": "bar"}]},
        {"Id": "b", "GpsPoints": {}, "Detail": {"en": {"Title": "x"}}, "Tags": []},
    ]
    path = tmp_path / "items.json"
    path.write_text(json.dumps({"Items": items, "TotalPages": 1}))
    places = snapshots.read_items(spark, str(path), item)
    wanted = spark.createDataFrame([("a",), ("a",), ("z",)], "Id string")
    assert relate.probe(wanted, places, "Id", "ordinal").count() == 2 and [r["Id"] for r in relate.missing(wanted, places, "Id").collect()] == ["z"]
    rows = poi.touristic_rows(places.drop("page", "ordinal"), "src").drop("addendum_json_poi")
    first = {r["id"]: r for r in rows.collect()}
    assert first["a"]["category_json"] == '["touristic:eating_out","touristic:bar"]' and first["b"]["name"] is None and first["b"]["name_en"] == "x"
    sinks.write_csv(rows, str(tmp_path / "csv"))
    text = "\n".join(r["value"] for r in spark.read.text(str(tmp_path / "csv/rows"), wholetext=True).collect())
    assert '"Al ""Bar"", uno"' in text and ',46.5,11.0,' in text
    back = {r["id"]: r for r in sinks.read_csv_text(rows, str(tmp_path / "csv")).collect()}
    assert back["a"]["name"] == 'Al "Bar", uno' and back["a"]["name_de"] == "Zur\nPost" and back["b"]["lat"] is None
    acco = spark.createDataFrame([("q", 1.0, 2.0, {"it": ("N",)}, ("Hotel stars",), ("4",))], "Id string, Latitude double, Longitude double, AccoDetail map<string,struct<Name:string>>, AccoType struct<Id:string>, AccoCategory struct<Id:string>")
    assert poi.accommodation_rows(acco, "s").first()["category_json"] == '["accomodation:Hotel_stars","accomodation:4"]'


def test_current_vehicles(spark, tmp_path):
    rows = [
        {"scode": "t1", "sname": "one", "tname": "position", "mvalue": {"lat": "46,5", "lon": "11,3"}},
        {"scode": "t1", "sname": "late", "tname": "state", "mvalue": "FREE"},
        {"scode": "t1", "sname": "late", "tname": "position", "mvalue": {"lat": "46.6", "lon": "x"}},
        {"scode": "t2", "sname": "two", "tname": "state", "mvalue": "OCCUPIED"},
        {"scode": "t3", "sname": "three", "tname": "speed", "mvalue": 3},
    ]
    path = tmp_path / "m.json"
    path.write_text(json.dumps({"data": rows}))
    out = poi.current_vehicles(snapshots.read_envelope(spark, str(path), snapshots.MEASUREMENT)).collect()
    assert [(r["Name"], r["Phone"], r["State"], r["lat"], r["lon"]) for r in out] == [("one", "t1", "FREE", 46.6, None)]


def test_replacement_and_publication(spark, tmp_path):
    now = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, source string")
    new = spark.createDataFrame([(9, "a")], "id int, source string")
    assert sorted(r["id"] for r in sinks.replaced_by_source(now, new).collect()) == [2, 3, 9]
    assert sorted(r["id"] for r in sinks.replaced_by_source(now, new, sources=["b"]).collect()) == [1, 3, 9]
    path = str(tmp_path / "by_source")
    sinks.replace_partitions(now.filter("source is not null"), path)
    sinks.replace_partitions(new, path)
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [2, 9]
    place = f"file://{tmp_path}/published"
    sinks.publish(now, place)
    sinks.publish(new, place)
    assert [r["id"] for r in sinks.published(spark, place).collect()] == [9]
    sinks.write_json(now, str(tmp_path / "json"))
    assert '"source":null' in "".join(r["value"] for r in spark.read.text(str(tmp_path / "json")).collect())


def test_stream_keeps_the_last_good_snapshot(spark, tmp_path):
    (tmp_path / "in").mkdir()
    place = f"file://{tmp_path}/current"
    run = lambda: streams.follow(spark, str(tmp_path / "in"), "scode string, n int", place, str(tmp_path / "ck")).awaitTermination(60)
    read = lambda: sorted(r["scode"] for r in sinks.published(spark, place).collect())
    for k, (text, want) in enumerate([('[{"scode":"a","n":1},{"scode":"b","n":2}]', ["a", "b"]), ("not json", ["a", "b"]), ('[{"scode":"c"}]', ["c"]), ("[]", [])]):
        (tmp_path / "in" / f"{k}.json").write_text(text)
        run()
        assert read() == want


def test_latest_polls(spark):
    polls = spark.createDataFrame([("s", 1, True), ("s", 2, False), ("b", 3, True), ("b", 3, True), ("x", 1, None)], "endpoint string, poll int, ok boolean")
    assert sorted((r["endpoint"], r["poll"]) for r in streams.latest(polls).collect()) == [("b", 3), ("b", 3), ("s", 1)]


def test_paged_rest(spark):
    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            page = int(self.path.rpartition("=")[2])
            body = json.dumps({"TotalPages": 3, "Items": [{"Id": f"{page}-{i}", "name": "ü"} for i in range(2)]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    rows = rest.read_pages(spark, f"http://127.0.0.1:{server.server_port}/x?page={{page}}")
    got = rows.withColumn("id", F.get_json_object("item", "$.Id")).orderBy("page", "ordinal").collect()
    server.shutdown()
    assert [r["id"] for r in got] == ["1-0", "1-1", "2-0", "2-1", "3-0", "3-1"]


def test_catalogues_and_jobs(spark):
    feeds = catalogue.feeds(spark, [{"feedId": "a", "type": "netex", "source": "data/a.zip", "groupFilePattern": "x"}, {"feedId": "b", "type": "gtfs", "source": "https://x/y"}])
    assert [r["feed_id"] for r in feeds.filter(catalogue.is_remote(F.col("source"))).collect()] == ["b"]
    assert catalogue.updaters(spark, [{"type": "siri", "url": "u"}]).first()["source_type"] is None
    files = spark.createDataFrame([("a", 100), ("b", 1_000_000)], "name string, modified long")
    assert [r["name"] for r in catalogue.stale(files, 1_000_000, 3).collect()] == ["a"]
    inputs = spark.createDataFrame([("a",), ("c",)], "name string")
    assert {r["name"]: r["action"] for r in catalogue.to_fetch(inputs, files).collect()} == {"a": "update", "c": "download"}
    times = spark.createDataFrame([(5, None), (5, 4), (4, 5)], "source_time int, derived_time int")
    assert catalogue.to_derive(times).count() == 2


def test_xml_and_binary(spark, tmp_path):
    (tmp_path / "t.xml").write_text('<frame><stop id="1"><Name>A</Name></stop><stop id="2"><Name>B</Name></stop></frame>')
    rows = snapshots.read_xml_rows(spark, str(tmp_path / "t.xml"), "stop", "_id string, Name string").collect()
    assert [(r["_id"], r["Name"]) for r in rows] == [("1", "A"), ("2", "B")]
    assert snapshots.read_binary(spark, str(tmp_path), "*.xml").select("length").count() == 1


def test_config():
    assert config.defaults({"a": 1, "b": None}, {"b": 2, "c": 3}) == {"a": 1, "b": None, "c": 3}
    assert config.endpoints({"x": {"path": "/x"}, "default": {"port": 1}}, {"default": {"port": 2, "host": "h"}}) == {"x": {"path": "/x", "port": 1, "host": "h"}}
