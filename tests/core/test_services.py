"""Readers of services and the writer of documents, against a local server and plain versions."""

import csv
import json
import os
import random
import re
import urllib.parse

import pytest
from pyspark.sql import functions as F

from tramline.sources import boxed, collections, documents, sinks
from tramline.streaming import polling

from .serving import serving

# located rows


@pytest.fixture(scope="module")
def located():
    rng = random.Random(1)
    rows = [{"scode": str(i), "scoordinate": {"x": rng.randrange(1000, 1300) / 100, "y": rng.randrange(4600, 4720) / 100}} for i in range(300)]
    return rows + [{"scode": "none"}, {"scode": "null", "scoordinate": None}]


@pytest.fixture
def service(located):
    asked = []

    def answer(method, path, headers, body):
        path = urllib.parse.unquote(path)
        box = re.search(r"bbc\.\(([^)]*)\)", path)
        asked.append(tuple(map(float, box[1].split(","))) if box else None)
        rows = located
        if box:
            x0, y0, x1, y1 = asked[-1]
            rows = [r for r in located if r.get("scoordinate") and x0 <= r["scoordinate"]["x"] <= x1 and y0 <= r["scoordinate"]["y"] <= y1]
        return 200, {}, json.dumps({"data": rows}).encode()

    with serving(answer) as url:
        yield url, asked


CONDITIONS = [
    ("x >= 10.5 and y >= 46.2 and x <= 12 and y <= 47", (10.5, 46.2, 12, 47), False),
    ("x between 11 and 11", (11, -90, 11, 90), False),
    ("x = 11.5", (11.5, -90, 11.5, 90), False),
    ("x > 10.5 and x < 12", (10.5, -90, 12, 90), True),
    ("y <= 46.5", (-180, -90, 180, 46.5), False),
    ("x >= 10.5 and x >= 11 and x <= 12 and x <= 13", (11, -90, 12, 90), False),
    ("x in (10.5, 11, 12)", (10.5, -90, 12, 90), True),
    ("x >= 11 or y >= 47", None, True),
    ("x >= 11 and (y <= 46.2 or y >= 47)", (11, -90, 180, 90), True),
    ("x <> 11", None, True),
    ("x is null", None, True),
    ("x >= 11 and ordinal < 40", (11, -90, 180, 90), True),
    ("true", None, False),
]


@pytest.mark.parametrize("condition, box, again", CONDITIONS)
@pytest.mark.parametrize("strips", [1, 4])
def test_conditions_on_coordinates_reach_the_request(spark, service, located, condition, box, again, strips):
    url, asked = service
    rows = boxed.read_located(spark, f"{url}/latest?limit=-1", "&where=scoordinate.bbc.({box})", strips=strips)
    got = rows.filter(condition)
    plan = got._jdf.queryExecution().executedPlan().toString()
    if "ordinal" not in condition:
        found = sorted(r["c"] for r in got.select(F.get_json_object("item", "$.scode").alias("c")).collect())
        plain = spark.createDataFrame([(r["scode"], *((r.get("scoordinate") or {}).get(c) for c in "xy")) for r in located], "c string, x double, y double")
        assert found == sorted(r["c"] for r in plain.filter(condition).collect())
        assert bool(re.search(r"\) Filter |- Filter ", plan)) == again, plan
    else:
        got.collect()
    if box is None:
        assert asked == [None]
    else:
        assert len(asked) == (strips if box[0] < box[2] else 1)
        assert (min(a[0] for a in asked), asked[0][1], max(a[2] for a in asked), asked[0][3]) == box


def test_a_box_ends_with_its_query(spark, service, located):
    url, asked = service
    rows = boxed.read_located(spark, f"{url}/latest?limit=-1", "&where=scoordinate.bbc.({box})")
    inside = rows.filter("x >= 11 and x <= 12").count()
    assert 0 < inside < rows.count() == len(located) and rows.filter("x >= 11 and x <= 12").count() == inside and [a is None for a in asked] == [False, True, False]


def test_a_box_that_is_empty_asks_nothing(spark, service):
    url, asked = service
    rows = boxed.read_located(spark, f"{url}/latest?limit=-1", "&where=scoordinate.bbc.({box})")
    assert rows.filter("x >= 12 and x <= 11").count() == 0 and asked == []
    assert rows.filter("x <= double('NaN')").count() >= 0 and all(a is None for a in asked)


def test_a_service_that_returns_more(spark, located):
    with serving(lambda *a: (200, {}, json.dumps({"data": located}).encode())) as url:
        rows = boxed.read_located(spark, url, "?box={box}", exact=False)
        assert rows.filter("x >= 11 and x <= 12").count() == sum(bool(r.get("scoordinate")) and 11 <= r["scoordinate"]["x"] <= 12 for r in located)


# collections

ROWS = {"stops": "gtfsId string, lat double", "stations": "gtfsId string", "vehicleParkings": "name string, tags array<string>", "rentalVehicles": "vehicleId string", "vehicleRentalStations": "stationId string, capacity int"}


def test_one_post_for_all_collections(spark, tmp_path):
    asked = []
    data = {"stops": [{"gtfsId": f"s{i}", "lat": i / 2} for i in range(50)], "stations": [], "vehicleParkings": [{"name": "ü", "tags": ["a"]}], "rentalVehicles": None, "more": {"x": 1}}

    def answer(method, path, headers, body):
        asked.append((method, headers["Content-Type"], json.loads(body)))
        return 200, {}, json.dumps({"data": data}).encode()

    with serving(answer) as url:
        tables = collections.read_posted(spark, url, "query A { stops { gtfsId } }", ROWS, {"n": 1}, str(tmp_path))
        assert {n: t.count() for n, t in tables.items()} == {"stops": 50, "stations": 0, "vehicleParkings": 1, "rentalVehicles": 0, "vehicleRentalStations": 0}
        first = tables["stops"].orderBy("ordinal").first()
        assert (first["gtfsId"], first["lat"], first["ordinal"]) == ("s0", 0.0, 0) and tables["vehicleParkings"].first()["tags"] == ["a"]
    assert asked == [("POST", "application/json", {"query": "query A { stops { gtfsId } }", "variables": {"n": 1}})]


@pytest.mark.parametrize("status, body", [(200, {"errors": [{"message": "no such field"}], "data": {"stops": []}}), (200, {"data": None}), (200, []), (500, {"data": {"stops": []}})])
def test_an_errors_reply_is_an_error(spark, tmp_path, status, body):
    with serving(lambda *a: (status, {}, json.dumps(body).encode())) as url, pytest.raises(Exception, match="ReplyError|HTTPError|no such field"):
        collections.read_posted(spark, url, "q", ROWS, None, str(tmp_path))


# documents


def test_envelope(spark, tmp_path):
    rows = spark.range(20_000).select(F.col("id").alias("n"), F.when(F.col("id") % 3 != 0, F.concat(F.lit('q"\n'), F.col("id"))).alias("name"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("docks"), (-F.col("id")).alias("o")).repartition(7)
    path = str(tmp_path / "feed.json")
    documents.write_envelope(rows, path, "stations", 99, "2.1", order="o", keep_nulls=["docks"], without="o")
    doc = json.loads(open(path).read())
    assert list(doc) == ["last_updated", "ttl", "version", "data"] and (doc["last_updated"], doc["ttl"], doc["version"]) == (99, 0, "2.1")
    want = [{"n": n} | ({"name": f'q"\n{n}'} if n % 3 else {}) | {"docks": n if n % 2 == 0 else None} for n in reversed(range(20_000))]
    assert doc["data"]["stations"] == want
    documents.write_envelope(rows.limit(0), path, "stations", 1, None)
    assert json.loads(open(path).read()) == {"last_updated": 1, "ttl": 0, "data": {"stations": []}}
    assert os.listdir(tmp_path) == ["feed.json"]


def test_csv_and_array_of_one_file(spark, tmp_path):
    rows = spark.createDataFrame([(2, 'a "b", c\nd', 1.5), (1, None, None), (3, "", 2.0)], "id int, name string, lat double")
    path = str(tmp_path / "x.csv")
    documents.write_csv_file(rows, path, order="id")
    with open(path, newline="") as f:
        assert list(csv.reader(f)) == [["id", "name", "lat"], ["1", "", ""], ["2", 'a "b", c\nd', "1.5"], ["3", "", "2.0"]]
    back = documents.read_csv_file(spark, path, rows.schema)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, rows.collect()))
    documents.write_array(rows.select("id"), str(tmp_path / "x.json"), order="id")
    assert json.loads((tmp_path / "x.json").read_text()) == [{"id": 1}, {"id": 2}, {"id": 3}]


def test_a_failure_leaves_the_old_document(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "feed.json")
    documents.write_array(spark.range(3), path, order="id")
    old = open(path).read()
    with pytest.raises(Exception, match="no row"):
        documents.write_array(spark.range(1000).select(F.when(F.col("id") == 900, F.raise_error(F.lit("no row"))).otherwise(F.col("id").cast("string")).alias("id")), path)
    assert open(path).read() == old and os.listdir(tmp_path) == ["feed.json"]
    writer = documents._Writer({"path": path, "head": '"["', "tail": '"]"'}, False)  # the commit ends midway
    with pytest.raises(FileNotFoundError):
        writer.commit([documents._Fragment(0, f"{tmp_path}/gone", 1)])
    assert open(path).read() == old and os.listdir(tmp_path) == ["feed.json"]


# polling


def run(spark, url, tmp_path, polls, state="ck", endpoints=("a", "b")):
    """Runs the stream until so many polls are through."""
    stream = polling.polls(spark, {e: f"{url}/{e}" for e in endpoints}, f"{tmp_path}/log", timeout=5)
    query = polling.follow_polls(stream, {e: "n long, s string" for e in endpoints}, f"{tmp_path}/now", f"{tmp_path}/{state}", "100 milliseconds")
    try:
        for _ in range(400):
            if query.lastProgress and query.lastProgress["batchId"] + 1 >= polls:
                break
            query.awaitTermination(0.1)
        else:
            raise AssertionError(query.status)
    finally:
        query.stop()


def table(spark, tmp_path, endpoint):
    return sorted((r["n"], r["poll"]) for r in sinks.published(spark, f"file://{polling.table_path(f'{tmp_path}/now', endpoint)}").collect())


def test_failed_polls_keep_the_table_and_replies_without_data_clear_it(spark, tmp_path):
    asked = {"a": 0, "b": 0}

    def answer(method, path, headers, body):
        name = path[1:]
        asked[name] += 1
        k = asked[name]
        if name == "b":
            return 200, {}, json.dumps({"data": [{"n": 7}]} if k == 1 else {}).encode()
        return (500, {}, b"") if k == 2 else (200, {}, b"no JSON" if k == 3 else json.dumps({"data": [{"n": k}, {"n": 10 * k}]}).encode())

    with serving(answer) as url:
        tmp = f"file://{tmp_path}"
        run(spark, url, tmp, 1)
        n = asked["a"]
        assert n >= 1
        first = table(spark, tmp_path, "a")
        assert len(first) == 2
        while asked["a"] < 3:
            run(spark, url, tmp, asked["a"] + 1)
        if asked["a"] == 3:
            assert table(spark, tmp_path, "a") == [(1, 0), (10, 0)]
        assert table(spark, tmp_path, "b") == []
        logged = spark.read.text(f"{tmp_path}/log/replies/*/a", wholetext=True).count()
        assert logged == asked["a"]


def test_a_batch_that_runs_again_has_the_same_rows(spark, tmp_path):
    """The query is killed in its batch, after the replies; the restarted one gets them from the log."""
    asked, seen = [], []

    def answer(method, path, headers, body):
        asked.append(path)
        return 200, {}, json.dumps({"data": [{"n": len(asked)}]}).encode()

    with serving(answer) as url:
        stream = lambda: polling.polls(spark, {"a": f"{url}/a", "b": f"{url}/b"}, f"file://{tmp_path}/log")

        def once(batch, number):
            rows = sorted((r["endpoint"], r["poll"], r["body"]) for r in batch.collect())
            seen.append((number, rows))
            if len(seen) == 1:
                raise RuntimeError("killed")

        query = stream().writeStream.foreachBatch(once).option("checkpointLocation", f"{tmp_path}/ck").start()
        with pytest.raises(Exception, match="killed"):
            query.awaitTermination(60)
        assert len(asked) == 2
        query = stream().writeStream.foreachBatch(once).option("checkpointLocation", f"{tmp_path}/ck").trigger(processingTime="300 milliseconds").start()
        for _ in range(300):
            if len(seen) >= 3:
                break
            query.awaitTermination(0.1)
        query.stop()
    assert seen[0] == seen[1] and seen[0][0] == 0 and [r[:2] for r in seen[0][1]] == [("a", 0), ("b", 0)]
    assert seen[2][1] != seen[1][1] and all(r[1] == 1 for r in seen[2][1])


def test_from_settings_to_feeds(spark, tmp_path):
    """Layered settings name the endpoints, a poll fills the tables, and these make a feed."""
    from tramline import config
    from tramline.plans import feeds
    from tramline.sources import snapshots

    replies = {
        "/s": [{"scode": "a", "sname": "A", "sorigin": feeds.ORIGINS["bz"], "sactive": True, "savailable": True, "smetadata": {"total-bays": 5}}],
        "/b": [{"scode": "a1", "pcode": "a", "savailable": True}, {"scode": "a2", "pcode": "a", "savailable": False}],
        "/k": [{"scode": "x", "pcode": "a1", "savailable": True, "smetadata": {"electric": True}}],
    }
    with serving(lambda m, path, h, b: (200, {}, json.dumps({"data": replies[path]}).encode())) as url:
        host, port = url.removeprefix("http://").split(":")
        found = config.endpoints({"stations": {"path": "/s"}, "bays": {"path": "/b"}, "bikes": {"path": "/k"}, "default": {"hostname": host}}, {"default": {"port": int(port), "hostname": "other"}})
        stream = polling.polls(spark, config.urls(found, "http"), f"file://{tmp_path}/log")
        kinds = {"stations": snapshots.STATION, "bays": snapshots.BAY, "bikes": snapshots.BIKE}
        query = polling.follow_polls(stream, kinds, f"file://{tmp_path}/now", f"{tmp_path}/ck", "10 minutes")
        for _ in range(400):
            if query.lastProgress:
                break
            query.awaitTermination(0.1)
        query.stop()
    tables = [sinks.published(spark, polling.table_path(f"file://{tmp_path}/now", e)) for e in ("stations", "bays", "bikes")]
    row = feeds.station_status(*tables, 99).first()
    assert (row["station_id"], row["num_docks_available"], row["num_bikes_available"], row["num_docks_disabled"]) == ("a", 3, 1, 1)
    assert [t["count"] for t in row["vehicle_types_available"]] == [0, 1] and [d["count"] for d in row["vehicle_docks_available"]] == [3]
