"""Archives and transfers against fixtures and a local server."""

import csv
import gzip
import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from tramline.sources import archives, transfer

from .serving import serving

NETEX = """<?xml version="1.0"?>
<PublicationDelivery xmlns="http://example.org/netex" xmlns:g="http://example.org/gml"><dataObjects><SiteFrame><stopPlaces>
<StopPlace id="S1" version="1"><Name lang="de">Böz &amp; Co</Name><Centroid><Location><Longitude>11.5</Longitude><Latitude>46.5</Latitude></Location></Centroid>
<quays><Quay id="Q1"/><Quay id="Q2"/></quays></StopPlace>
<StopPlace id="S2" version="2" g:kind="x"><Name>Two</Name></StopPlace></stopPlaces></SiteFrame></dataObjects></PublicationDelivery>"""


@pytest.fixture(scope="module")
def feeds(tmp_path_factory):
    folder = tmp_path_factory.mktemp("feeds")
    stops = io.StringIO()
    out = csv.writer(stops)
    out.writerow(["stop_id", "stop_name", "stop_lat", "stop_lon"])
    out.writerows([[f"s{i}", f'Stop "{i}", x\ny', 46 + i / 100, ""] for i in range(2_500)])
    with zipfile.ZipFile(folder / "one.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("stops.txt", "﻿" + stops.getvalue())
        z.writestr("sub/routes.txt", "route_id,route_type\nr1,3\nr2\nr3,bus,more\n")
        z.writestr("readme.md", "no table")
    with zipfile.ZipFile(folder / "two.zip", "w") as z:
        z.writestr("stops.txt", "stop_id,extra\nzz,1\n")
        z.writestr("_shared.xml", NETEX)
        z.writestr("line.xml", NETEX.replace("S1", "L1").replace("S2", "L2"))
    (folder / "other.txt").write_text("not an archive")
    return str(folder)


def test_members_are_partitions(spark, feeds):
    rows = archives.read_members(spark, feeds)
    assert rows.rdd.getNumPartitions() == 3
    assert {(r["archive"].rpartition("/")[2], r["member"], r["n"]) for r in rows.groupBy("archive", "member").agg(F.count("*").alias("n")).collect()} == {("one.zip", "stops.txt", 2500), ("one.zip", "sub/routes.txt", 3), ("two.zip", "stops.txt", 1)}
    assert archives.read_members(spark, f"{feeds}/one.zip", r"sub/.*").rdd.getNumPartitions() == 1
    assert archives.read_members(spark, feeds, r"nothing").count() == 0


def test_tables_of_archives(spark, feeds):
    stops = archives.read_table(spark, [f"file://{feeds}/one.zip", f"{feeds}/two.zip"], "stops.txt", "stop_id string, stop_name string, stop_lat double, stop_lon double, zone_id string")
    rows = {r["stop_id"]: r for r in stops.collect()}
    assert len(rows) == 2_501 and rows["s7"]["stop_name"] == 'Stop "7", x\ny' and rows["s7"]["stop_lat"] == 46.07 and rows["s7"]["stop_lon"] is None and rows["s7"]["zone_id"] is None
    assert rows["zz"]["stop_name"] is None and rows["s7"]["ordinal"] == 7
    routes = {r["route_id"]: r["route_type"] for r in archives.read_table(spark, feeds, "routes.txt", "route_id string, route_type int").collect()}
    assert routes == {"r1": 3, "r2": None, "r3": None}


def test_elements_of_archives(spark, feeds):
    rows = archives.read_elements(spark, feeds, "StopPlace", "_id string, _version int, _kind string, Name struct<_VALUE:string,_lang:string>, Centroid struct<Location:struct<Longitude:double,Latitude:double>>, quays struct<Quay:array<struct<_id:string>>>")
    found = {(r["member"], r["_id"]): r for r in rows.collect()}
    assert set(found) == {("_shared.xml", "S1"), ("_shared.xml", "S2"), ("line.xml", "L1"), ("line.xml", "L2")} and rows.rdd.getNumPartitions() == 2
    first = found["_shared.xml", "S1"]
    assert (first["Name"]["_VALUE"], first["Name"]["_lang"], first["Centroid"]["Location"]["Latitude"], [q["_id"] for q in first["quays"]["Quay"]]) == ("Böz & Co", "de", 46.5, ["Q1", "Q2"])
    assert found["line.xml", "L2"]["_kind"] == "x" and found["line.xml", "L2"]["Centroid"] is None
    quays = archives.read_members(spark, feeds, r"line\.xml", "Quay").collect()
    assert [r["fields"]["id"] for r in quays] == ["Q1", "Q2"]


def test_written_archives_come_back(spark, tmp_path):
    rng = random.Random(1)
    rows = [(f"a{i % 3}.zip", f"m{i % 5}.txt", i, f"{i},ü{rng.random()}") for i in range(3_000)]
    lines = spark.createDataFrame(rows, "archive string, member string, ordinal int, value string").repartition(6)
    heads = lines.select("archive", "member").distinct().withColumn("ordinal", F.lit(-1)).withColumn("value", F.lit("n,v"))
    assert archives.write_archives(lines.unionByName(heads), f"file://{tmp_path}") == [(f"a{k}.zip", 1_005) for k in range(3)]
    back = archives.read_members(spark, str(tmp_path), r"m\d\.txt").select(F.element_at(F.split("archive", "/"), -1), "member", F.col("fields.n").cast("int").alias("n"), F.concat_ws(",", "fields.n", "fields.v"))
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    assert [r["n"] for r in back.filter("member = 'm1.txt'").orderBy("archive", "ordinal").limit(3).collect()] if "ordinal" in back.columns else True


# transfer


def test_transfer_by_manifest(spark, tmp_path):
    content = {"plain": b"plain " * 50_000, "packed": gzip.compress(b"<x/>" * 40_000) + gzip.compress(b"<y/>"), "dated": b"by date", "gone": b"", "cut": b"c" * 100_000, "half": gzip.compress(random.Random(2).randbytes(90_000))[:-4_000]}
    state = {"version": 1, "asked": [], "served": 0, "cut": False}

    def answer(method, path, headers, body):
        name = path[1:]
        state["asked"].append((name, headers["If-None-Match"], headers["If-Modified-Since"]))
        if name == "gone":
            return 404, {}, b""
        tag, date = f'"{name}-{state["version"]}"', "Sat, 28 Nov 2026 00:00:00 GMT"
        if name == "dated":
            if headers["If-Modified-Since"] == date:
                return 304, {}, b""
            return 200, {"Last-Modified": date}, content[name]
        if headers["If-None-Match"] == tag:
            return 304, {}, b""
        state["served"] += 1
        data = content[name] + (b"!" if state["version"] > 1 and name == "plain" else b"")
        return 200, {"ETag": tag, "Content-Length": str(len(data) + (10 if name == "cut" and state["cut"] else 0))}, data

    with serving(answer) as url:
        rows = [("plain", f"{url}/plain", "plain.txt", False, None), ("packed", f"{url}/packed", "packed.zip", True, "packed.xml"), ("dated", f"{url}/dated", "dated.txt", None, None), ("gone", f"{url}/gone", "gone.txt", False, None), ("cut", f"{url}/cut", "cut.txt", False, None), ("half", f"{url}/half", "half.txt", True, None)]
        feeds = spark.createDataFrame(rows, "name string, url string, target string, gunzip boolean, member string")
        run = lambda f=feeds: {r["name"]: r for r in transfer.transfer(f, f"file://{tmp_path}/data", f"file://{tmp_path}/manifest", tries=1).collect()}
        first = run()
        assert {n: r["action"] for n, r in first.items()} == {"plain": "downloaded", "packed": "downloaded", "dated": "downloaded", "gone": "failed", "cut": "downloaded", "half": "failed"}
        assert first["gone"]["error"] == "HTTP 404" and (tmp_path / "data/plain.txt").read_bytes() == content["plain"] and first["plain"]["bytes"] == 300_000
        with zipfile.ZipFile(tmp_path / "data/packed.zip") as z:
            assert z.namelist() == ["packed.xml"] and z.read("packed.xml") == b"<x/>" * 40_000 + b"<y/>"
        assert sorted(p.name for p in (tmp_path / "data").iterdir()) == ["cut.txt", "dated.txt", "packed.zip", "plain.txt"]

        served, whole_feeds = state["served"], feeds.filter("name not in ('gone', 'half')")
        second = run(whole_feeds)  # nothing has changed
        assert {second[n]["action"] for n in ("plain", "packed", "dated", "cut")} == {"unchanged"} and state["served"] == served
        assert second["plain"]["etag"] == first["plain"]["etag"] and second["plain"]["bytes"] == 300_000
        assert second["gone"]["action"] == "failed"  # not asked for: its entry stays

        state |= {"version": 2, "cut": True}
        third = run(whole_feeds)
        assert third["plain"]["action"] == "downloaded" and (tmp_path / "data/plain.txt").read_bytes().endswith(b"!")
        assert third["cut"]["action"] == "failed" and "Cut" in third["cut"]["error"] and third["cut"]["etag"] == first["cut"]["etag"]
        assert (tmp_path / "data/cut.txt").read_bytes() == content["cut"]  # the old file
        assert not [p for p in (tmp_path / "data").iterdir() if p.name.startswith(".")]
        (tmp_path / "data/dated.txt").unlink()  # a file that is missing is asked for without conditions
        assert run(whole_feeds.filter("name = 'dated'"))["dated"]["action"] == "downloaded"
