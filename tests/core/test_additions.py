"""Rules added to the display, the polling source and publication."""

import http.server
import json
import threading

from pyspark.sql import functions as F

from tramline.functions import display as D
from tramline.functions import semantics as S
from tramline.plans import poi
from tramline.sources import rest, sinks


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_rounding_and_parsed_properties(spark):
    r = one(spark, a=S.rounded(F.lit(2.5)), b=S.rounded(F.lit(-2.5)), c=S.rounded(F.lit(None).cast("double")), d=S.parsed_property(F.lit('["x"]'), "array<string>"), e=S.parsed_property(F.lit(""), "array<string>"))
    assert (r["a"], r["b"], r["c"], r["d"], r["e"]) == (3.0, -2.0, None, ["x"], None)


def test_layers_tags_and_brands(spark):
    kind = "array<struct<type:string,layers:array<struct<type:string>>>>"
    overlays = F.from_json(F.lit(json.dumps([{"type": "otp2", "layers": [{"type": "stops"}, {"type": "areas"}]}, {"type": "other", "layers": [{"type": "x"}]}, {"type": "otp2"}])), kind)
    types = D.layer_types(overlays)
    tags = F.create_map(F.lit("a"), F.lit("1"))
    brand = {"h": {"title": "T"}}
    r = one(
        spark, t=types, u=D.tile_url(F.lit("e"), types), none=D.layer_types(F.lit(None).cast(kind)), yes=D.tagged(tags, {"a": ["1"], "b": ["2"]}), no=D.tagged(tags, {"b": ["1"]}),
        title=D.branded(F.lit("h"), brand, "title", F.lit("d")), other=D.branded(F.lit("i"), brand, "title", F.lit("d")), brand=D.branded(F.lit("h"), brand, "branding", F.lit("d")),
    )
    assert r["t"] == ["stops", "areas"] and r["u"] == "e/stops,areas/tilejson.json" and r["none"] == [] and r["yes"] and not r["no"]
    assert (r["title"], r["other"], r["brand"]) == ("T", "d", None)


def test_platforms_and_operators(spark):
    r = one(spark, a=D.highlighted(F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit('["r"]')), b=D.highlighted(F.lit("p"), F.lit("p"), F.lit("[]")), c=D.platform_shown(F.lit("1"), F.lit(None).cast("string")), d=D.live_dot_shown(F.lit(None).cast("boolean")))
    assert (r["a"], r["b"], r["c"], r["d"]) == (True, False, False, False)
    stops = spark.createDataFrame([(1, [(("A",),), (("B",),)]), (2, []), (3, None), (4, [(None,)])], "id int, routes array<struct<agency:struct<gtfsId:string>>>")
    operators = spark.createDataFrame([("A", "second", 2), ("A", "first", 1), ("B", "b", 3), (None, "n", 0)], "agencyId string, name string, ordinal int")
    assert {r["id"]: r["operator"] for r in poi.with_operator(stops, operators).collect()} == {1: "first", 2: None, 3: None, 4: None}


def test_an_endpoint_is_polled_once_in_a_batch(spark, tmp_path):
    polls = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            polls.append(self.path)
            body = json.dumps({"data": [{"n": len(polls)}]}).encode() if len(polls) != 2 else b"no JSON"
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    seen = []
    stream = rest.poll(spark, f"http://127.0.0.1:{server.server_port}/x", "bikes")
    query = stream.writeStream.foreachBatch(lambda b, n: seen.extend(b.collect())).option("checkpointLocation", str(tmp_path)).trigger(processingTime="200 milliseconds").start()
    try:
        for _ in range(300):
            if len(seen) >= 3:
                break
            query.awaitTermination(0.2)
    finally:
        query.stop()
        server.shutdown()
    assert [r["poll"] for r in seen[:3]] == [0, 1, 2] and {r["endpoint"] for r in seen} == {"bikes"}
    assert seen[0]["body"] is not None and seen[1]["body"] is None and json.loads(seen[2]["body"])["data"][0]["n"] == 3


def test_publication_replaces_the_pointer(spark, tmp_path):
    path = f"file://{tmp_path}/table"
    for n in (3, 5):
        sinks.publish(spark.range(n), path)
        assert sinks.published(spark, path).count() == n
    assert [p.name for p in (tmp_path / "table").iterdir() if p.name.startswith("CURRENT")] == ["CURRENT"]
