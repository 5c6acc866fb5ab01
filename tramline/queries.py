"""Registered queries of the engine's operators over the driver tables, and the same as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import display as D
from .functions import geo
from .functions import semantics as S
from .functions.cells import points_in_rings
from .operators import facets as facet
from .operators import relate
from .operators.nearest import nearest
from .plans import analogues as A
from .plans import elements, feeds, poi
from .sources import archives, documents, sinks, snapshots
from .sources.files import scratch
from .sources.sinks import replaced_by_source
from .streaming.snapshots import latest

NOW = 1_700_000_000
RING = [(-0.9, -0.8), (0.7, -0.9), (0.95, 0.3), (0.2, 0.15), (0.5, 0.9), (-0.6, 0.7), (-0.9, -0.8)]
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


_POINT = "10.0 + ({0} % 281) / 100.0 AS lon, 46.0 + ({0} % 121) / 100.0 AS lat"


@_query(f"""
    SELECT c_custkey::VARCHAR AS station_id, c_name AS name, lat, lon, c_mktsegment AS address, 'BZ' AS region_id, CASE WHEN c_custkey % 7 <> 0 THEN nullif((c_custkey % 13) * 2, 0) END AS capacity
    FROM (SELECT *, {_POINT.format('c_custkey')} FROM customer) WHERE c_custkey % 3 <> 0 AND c_acctbal > -500 AND c_nationkey <> 4 AND c_custkey % 5 <> 0""")
def station_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.station_information(A.stations(spark, sf_dir))


@_query(f"""
    WITH bay AS (SELECT l_orderkey AS k, count(*) FILTER (WHERE l_returnflag = 'N') AS n, count(*) FILTER (WHERE l_returnflag = 'N' AND l_linestatus = 'O') AS e FROM lineitem GROUP BY 1),
    st AS (SELECT o_custkey AS k, count(*) FILTER (WHERE o_orderstatus = 'F') AS disabled, sum(coalesce(n, 0)) AS bikes, sum(coalesce(e, 0)) AS electric FROM orders LEFT JOIN bay ON k = o_orderkey GROUP BY 1),
    s AS (SELECT *, c_custkey % 11 <> 0 AS counted, coalesce(disabled, 0) AS d, coalesce(bikes, 0) AS b, coalesce(electric, 0) AS e FROM customer LEFT JOIN st ON k = c_custkey
          WHERE c_custkey % 3 <> 0 AND c_acctbal > -500 AND c_nationkey <> 4)
    SELECT c_custkey::VARCHAR AS station_id, true AS is_renting, true AS is_installed, true AS is_returning,
           (CASE WHEN NOT counted THEN 0 WHEN c_custkey % 7 = 0 THEN NULL ELSE greatest(0, (c_custkey % 13) * 2 - d - b) END)::BIGINT AS num_docks_available,
           (CASE WHEN counted THEN b ELSE c_nationkey - 5 END)::BIGINT AS num_bikes_available,
           (CASE WHEN counted THEN d END)::BIGINT AS num_docks_disabled, CASE WHEN counted THEN '[{{"vehicle_type_ids":["bike","e-bike"],"count":' || coalesce((CASE WHEN c_custkey % 7 <> 0 THEN greatest(0, (c_custkey % 13) * 2 - d - b) END)::BIGINT::VARCHAR, 'null') || '}}]' END AS vehicle_docks_available,
           CASE WHEN counted THEN '[{{"vehicle_type_id":"bike","count":' || (b - e)::BIGINT::VARCHAR || '}},{{"vehicle_type_id":"e-bike","count":' || e::BIGINT::VARCHAR || '}}]' END AS vehicle_types_available,
           {NOW}::BIGINT AS last_reported
    FROM s WHERE counted OR (c_custkey % 22 <> 0 AND c_nationkey >= 5)""")
def station_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.station_status(A.stations(spark, sf_dir), A.bays(spark, sf_dir), A.bikes(spark, sf_dir), NOW)
    return rows.withColumns({c: F.to_json(c, {"ignoreNullFields": "false"}) for c in ("vehicle_docks_available", "vehicle_types_available")})


@_query(f"""
    WITH h AS (SELECT *, {_POINT.format('s_suppkey')}, CASE WHEN s_nationkey % 5 <> 0 THEN lpad((s_nationkey % 9)::VARCHAR, 2, '0') || ':00' ELSE '' END AS a, CASE WHEN s_nationkey % 7 <> 0 THEN '19:00' END AS z,
               CASE WHEN s_nationkey % 2 = 0 THEN '12:00' END AS l1, CASE WHEN s_nationkey % 4 = 0 THEN '14:00' END AS l2 FROM supplier WHERE s_acctbal > 0)
    SELECT s_suppkey::VARCHAR AS station_id, s_name AS name, lat, lon, 'PAPIN' AS region_id,
           CASE WHEN a <> '' AND z <> '' THEN CASE WHEN l1 <> '' AND l2 <> '' THEN 'Mo-Su ' || a || '-' || l1 || ', Mo-Su ' || l2 || '-' || z ELSE 'Mo-Su ' || a || '-' || z END END AS station_opening_hours
    FROM h""")
def opening_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.rental_station_information(A.rental_stations(spark, sf_dir))


@_query(f"""
    SELECT s_suppkey::VARCHAR AS station_id, true AS is_renting, true AS is_installed, true AS is_returning, 100::BIGINT AS num_docks_available, 100::BIGINT AS num_bikes_available, {NOW}::BIGINT AS last_reported
    FROM supplier WHERE s_acctbal > 0
    UNION ALL SELECT s_suppkey::VARCHAR, false, false, true, 1000, 0, {NOW} FROM supplier""")
def constant_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relate.union_all(feeds.rental_station_status(A.rental_stations(spark, sf_dir), NOW), feeds.virtual_station_status(A.areas(spark, sf_dir), NOW))


@_query("""
    WITH a AS (SELECT s_suppkey AS k, '46.' || lpad((s_suppkey % 97)::VARCHAR, 2, '0') AS lat, '11.' || lpad((s_suppkey % 89)::VARCHAR, 2, '0') AS lon FROM supplier)
    SELECT k::VARCHAR AS station_id, 'area/' || (k % 30)::VARCHAR || CASE WHEN k % 3 = 0 THEN '_b' ELSE '' END AS name, idx::INT AS idx, (lon || y)::DOUBLE AS lon, (lat || x)::DOUBLE AS lat
    FROM a, (VALUES (0, '1', '1'), (1, '1', '5'), (2, '5', '5'), (3, '1', '1')) AS c(idx, x, y)""")
def virtual_station_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.virtual_station_information(A.areas(spark, sf_dir))
    ring = F.get(F.get("station_area.coordinates", F.lit(0)), F.lit(0))
    return rows.select("station_id", "name", F.posexplode(ring).alias("idx", "p")).select("station_id", "name", "idx", F.get("p", F.lit(0)).alias("lon"), F.get("p", F.lit(1)).alias("lat"))


@_query(f"""
    WITH d AS (SELECT 'area_' || (s_suppkey % 30)::VARCHAR || CASE WHEN s_suppkey % 3 = 0 THEN '_b' ELSE '' END AS name, min(s_suppkey) AS k FROM supplier GROUP BY 1)
    SELECT p_partkey::VARCHAR AS bike_id, lat, lon, p_partkey % 4 IN (0, 1) AS is_reserved, p_partkey % 4 IN (0, 2) AS is_disabled, 'bike' AS vehicle_type_id, coalesce(k::VARCHAR, 'unknown') AS station_id
    FROM (SELECT *, {_POINT.format('p_partkey')} FROM part) LEFT JOIN d ON name = 'area_' || (p_size % 40)::VARCHAR WHERE p_partkey % 6 <> 0 AND p_partkey % 10 <> 0""")
def free_vehicle_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.free_bike_status(A.loose_bikes(spark, sf_dir), A.areas(spark, sf_dir))


_PLUG = """
    plug AS (SELECT l_orderkey AS k, l_linenumber AS n, l_quantity > 25 AS free,
                    CASE l_linenumber % 3 WHEN 0 THEN 'type ' || l_returnflag WHEN 1 THEN l_linestatus ELSE 'undefined' END AS t,
                    CASE l_linenumber % 3 WHEN 0 THEN l_quantity WHEN 1 THEN 11.0 END AS p FROM lineitem WHERE l_linenumber <> 7)"""


@_query(f"""
    WITH {_PLUG},
    types AS (SELECT k, string_agg(DISTINCT t, '|' ORDER BY t) AS types FROM plug GROUP BY 1),
    nest AS (SELECT k, count(*) AS n_plugs, count(*) FILTER (WHERE free) AS free, sum(p) AS power FROM plug GROUP BY 1)
    SELECT o_orderkey::VARCHAR AS station_id, CASE WHEN o_orderkey % 3 = 0 THEN 'Sankt ' || array_to_string([upper(x[1]) || lower(x[2:]) FOR x IN string_split(o_orderpriority, ' ')], ' ') ELSE 'Neu-markt Am See' END AS city,
           (CASE WHEN o_orderkey % 4 = 1 AND o_orderkey % 9 <> 0 THEN o_orderkey % 9 ELSE coalesce(n_plugs, 0) END)::BIGINT AS capacity, coalesce(free, 0)::BIGINT AS free,
           'provider ' || (o_orderkey % 6)::VARCHAR AS provider, CASE WHEN o_orderkey % 2 = 0 THEN 'yes' ELSE 'no' END AS reservable, coalesce(types, '') AS types, coalesce(n_plugs, 0)::BIGINT AS n_plugs, power
    FROM (SELECT *, {_POINT.format('o_orderkey')} FROM orders) LEFT JOIN nest ON nest.k = o_orderkey LEFT JOIN types ON types.k = o_orderkey
    WHERE o_orderstatus <> 'P' AND lon BETWEEN 10.5 AND 12 AND lat BETWEEN 46.2 AND 47""")
def charger_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feeds.charger_stations(A.chargers(spark, sf_dir), A.plugs(spark, sf_dir), "10.5,46.2,12,47")
    power = F.when(F.exists("plugs", lambda p: p["maxPower"].isNotNull()), F.aggregate("plugs", F.lit(0.0), lambda a, p: a + F.coalesce(p["maxPower"], F.lit(0.0))))
    return rows.select("station_id", "city", "capacity", "free", "provider", "reservable", F.array_join(F.array_sort("plugsTypes"), "|").alias("types"), F.size("plugs").cast("bigint").alias("n_plugs"), power.alias("power"))


@_query(f"""
    WITH {_PLUG}
    SELECT 'provider' AS facet, 'provider ' || (o_orderkey % 6)::VARCHAR AS value FROM orders UNION SELECT 'accessType', CASE WHEN o_orderkey % 5 <> 0 THEN o_orderstatus ELSE 'undefined' END FROM orders
    UNION SELECT 'reservable', CASE WHEN o_orderkey % 2 = 0 THEN 'yes' ELSE 'no' END FROM orders UNION SELECT 'state', o_orderstatus FROM orders
    UNION SELECT 'plugsTypes', t FROM plug JOIN orders ON k = o_orderkey""")
def charger_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.charger_facets(A.chargers(spark, sf_dir), A.plugs(spark, sf_dir))


@_query("SELECT 'p_brand' AS facet, p_brand AS value FROM part UNION SELECT 'p_type', p_type FROM part UNION SELECT 'p_size', p_size::VARCHAR FROM part")
def facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facet.facets(A.table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size"])


@_query("SELECT vec_id, label FROM embeddings WHERE embedding[1] BETWEEN -0.1 AND 0.15 AND embedding[2] BETWEEN -0.2 AND 0.1")
def bbox_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda i: F.get("embedding", F.lit(i))
    return A.table(spark, sf_dir, "embeddings").filter(geo.in_bbox(at(0), at(1), geo.parse_bbox("-0.1,-0.2,0.15,0.1"))).select("vec_id", "label")


_EDGES = ", ".join(f"({a[0]}, {a[1]}, {b[0]}, {b[1]})" for a, b in zip(RING, RING[1:]))


@_query(f"""
    WITH p AS (SELECT vec_id, embedding[1]::DOUBLE * 8 AS x, embedding[2]::DOUBLE * 8 AS y FROM embeddings),
    e AS (SELECT ax::DOUBLE AS ax, ay::DOUBLE AS ay, bx::DOUBLE AS bx, b_y::DOUBLE AS b_y FROM (VALUES {_EDGES}) AS v(ax, ay, bx, b_y))
    SELECT vec_id FROM p JOIN e ON (ay > y) <> (b_y > y) AND x < (bx - ax) * (y - ay) / (b_y - ay) + ax GROUP BY 1 HAVING count(*) % 2 = 1""")
def point_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = lambda i: F.get("embedding", F.lit(i)).cast("double") * 8
    return geo.inside(A.table(spark, sf_dir, "embeddings").select("vec_id", at(0).alias("x"), at(1).alias("y")), "x", "y", RING).select("vec_id")


_STOP = """
    route AS (SELECT o_custkey AS k, CASE o_orderpriority[1] WHEN '1' THEN 'RAIL' WHEN '2' THEN 'AIRPLANE' WHEN '5' THEN 'FERRY' ELSE 'BUS' END AS m FROM orders),
    placed AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN 'stop:' || c_custkey::VARCHAR ELSE c_nationkey::VARCHAR END AS id, m FROM route JOIN customer ON k = c_custkey),
    poi AS (SELECT id, count(*) AS n_routes, string_agg(DISTINCT m, ',' ORDER BY m) AS modes,
                   max(CASE m WHEN 'RAIL' THEN 1000 ELSE 0 END) + max(CASE m WHEN 'AIRPLANE' THEN 1500 ELSE 0 END) + max(CASE m WHEN 'BUS' THEN 500 ELSE 0 END) + 250 * count(*) AS popularity FROM placed GROUP BY 1)"""


@_query(f"WITH {_STOP} SELECT id, n_routes::BIGINT AS n_routes, modes, popularity::BIGINT AS popularity, 'public_transport,public_transport:stop,public_transport:stop:' || lower(replace(modes, ',', ',public_transport:stop:')) AS categories FROM poi")
def station_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = poi.search_stops(*A.stops(spark, sf_dir))
    modes, head = F.array_sort("vehicleMode"), F.slice("categories", 1, 2)
    tail = F.array_sort(F.filter("categories", lambda c: F.length(c) > len("public_transport:stop")))
    return rows.select(F.col("gtfsId").alias("id"), F.size("routes").cast("bigint").alias("n_routes"), F.array_join(modes, ",").alias("modes"), "popularity", F.array_join(F.concat(head, tail), ",").alias("categories"))


@_query("""
    SELECT l_orderkey, string_agg(DISTINCT 'flag:' || lower(l_returnflag), ',' ORDER BY 'flag:' || lower(l_returnflag)) AS modes FROM lineitem GROUP BY 1""")
def stop_filter_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = A.table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("mode"), F.col("l_linenumber").alias("n"))
    orders = A.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    stops = relate.nest_children(orders, lines.withColumnRenamed("l_orderkey", "parent"), "l_orderkey", "parent", "n", ["mode"], "routes")
    return poi.routed(stops).select("l_orderkey", F.array_join(F.array_sort(S.prefixed_lower("flag:", F.col("vehicleMode"))), ",").alias("modes"))


@_query("SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def poi_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relate.probe(A.table(spark, sf_dir, "labels"), A.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id", "n_chars")


@_query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def poi_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relate.missing(A.table(spark, sf_dir, "documents").select("doc_id", "lang"), A.table(spark, sf_dir, "labels").select("doc_id"), "doc_id")


@_query("SELECT p_partkey, 'touristic:' || replace(p_type, ' ', '_') AS category FROM part")
def category_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.table(spark, sf_dir, "part").select("p_partkey", S.slug("touristic:", F.col("p_type")).alias("category"))


@_query("SELECT event_id, json_valid(props) AS is_json, json_type(props) = 'OBJECT' AS is_object, len(json_keys(props))::INT AS n_keys FROM events")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.try_parse_json("props")
    return A.table(spark, sf_dir, "events").select("event_id", v.isNotNull().alias("is_json"), F.schema_of_variant(v).startswith("OBJECT").alias("is_object"), F.size(F.json_object_keys("props")).alias("n_keys"))


@_query("SELECT doc_id, lang, (doc_id % 3)::BIGINT AS page FROM documents")
def page_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = A.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return relate.union_all(*[docs.filter(F.col("doc_id") % 3 == p).withColumn("page", F.lit(p).cast("bigint")) for p in range(3)])


@_query("""
    SELECT doc_id, source, 'old' AS version FROM documents WHERE source NOT IN (SELECT source FROM documents WHERE doc_id % 50 = 7)
    UNION ALL SELECT doc_id, source, 'new' FROM documents WHERE doc_id % 50 = 7""")
def replace_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = A.table(spark, sf_dir, "documents").select("doc_id", "source")
    return replaced_by_source(docs.withColumn("version", F.lit("old")), docs.filter("doc_id % 50 = 7").withColumn("version", F.lit("new")))


@_query("""
    SELECT user_id, arg_max(value, event_id) FILTER (WHERE event_type = 'view') AS "view", arg_max(value, event_id) FILTER (WHERE event_type = 'click') AS click, arg_min(event_type, event_id) AS first_type
    FROM events GROUP BY 1""")
def measurement_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = A.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", F.col("event_type").alias("first_type"))
    return relate.pivot_last(events, "user_id", "event_type", "value", "event_id", ["view", "click"], ["first_type"])


@_query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def keyed_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = A.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return relate.last_by(events, "user_id", F.struct("ts", "event_id")).drop("ts")


@_query("SELECT event_id, (event_id % 1000)::DOUBLE + (event_id % 100) / 100.0::DOUBLE AS x, CASE WHEN event_id % 9 <> 0 THEN (event_id % 7)::DOUBLE END AS y FROM events")
def decimal_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    x = F.concat((i % 1000).cast("string"), F.lit(","), F.lpad((i % 100).cast("string"), 2, "0"), F.lit(" E"))
    y = F.when(i % 9 == 0, "n/a").otherwise((i % 7).cast("string"))
    return A.table(spark, sf_dir, "events").select("event_id", S.decimal_comma(x).alias("x"), S.decimal_comma(y).alias("y"))


@_query("""
    WITH t AS (SELECT l_orderkey, bool_or(l_returnflag = 'A' AND l_linenumber > 3) AS odd, bool_and(l_linenumber % 2 = 1) AS every FROM lineitem GROUP BY 1)
    SELECT l_orderkey FROM t WHERE CASE WHEN l_orderkey % 2 = 0 THEN NOT odd ELSE NOT every END""")
def unknown_type_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = A.table(spark, sf_dir, "lineitem")
    kind = F.when((F.col("l_returnflag") == "A") & (F.col("l_linenumber") > 3), "Unknown").otherwise(F.col("l_returnflag"))
    code = F.when(F.col("l_linenumber") % 2 == 1, "UNDEFINED").otherwise("type2")
    nested = lines.groupBy("l_orderkey").agg(F.collect_set(kind).alias("types"), F.collect_list(code).alias("codes"))
    types = F.when(F.col("l_orderkey") % 2 == 0, F.col("types")).otherwise(F.array().cast("array<string>"))
    return nested.filter(D.known_types(types, F.col("codes"))).select("l_orderkey")


@_query("SELECT event_id, event_type FROM events WHERE event_type IN ('view', 'click') AND (event_type <> 'view' OR value > 50)")
def nearby_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "view", "Stop").otherwise(F.col("event_type"))
    return A.table(spark, sf_dir, "events").filter(D.nearby_shown(kind, F.when(F.col("value") > 50, 1).otherwise(0), ["Stop", "click"])).select("event_id", "event_type")


@_query("""
    SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 1.0 WHEN c_custkey % 5 = 1 THEN 2.0 WHEN c_custkey % 5 = 2 AND c_nationkey <> 0 THEN c_nationkey::DOUBLE WHEN c_custkey % 5 <> 3 THEN 4.0 WHEN c_custkey % 2 = 0 THEN 5.0 END AS lat FROM customer""")
def nearby_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    p = lambda lat: F.struct(F.lit(lat).cast("double").alias("lat"), F.lit(9.0).alias("lon"))
    flat = F.struct(F.when(k % 5 == 2, F.col("c_nationkey")).cast("double").alias("lat"), F.lit(9.0).alias("lon"))
    found = D.nearby_point(F.when(k % 5 == 0, p(1)), F.when(k % 5 == 1, p(2)), flat, F.when(k % 5 != 3, p(4)), F.when(k % 2 == 0, p(5)))
    return A.table(spark, sf_dir, "customer").select("c_custkey", found["lat"].alias("lat"))


@_query("""
    SELECT o_orderkey, strftime(timezone('Europe/Rome', to_timestamp(epoch(o_orderdate))), '%Y-%m-%d') AS first_day,
           CASE WHEN o_orderkey % 3 = 0 THEN (year(o_orderdate) + 1)::VARCHAR || '-12-31' ELSE strftime(timezone('Europe/Rome', to_timestamp(epoch(o_orderdate) - 1)), '%Y-%m-%d') END AS last_day,
           CASE WHEN o_orderkey % 4 = 0 THEN false ELSE '1996-06-01' BETWEEN first_day AND last_day END AS in_range FROM orders""")
def calendar_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    first, last = S.calendar_bounds(at, F.when(F.col("o_orderkey") % 3 == 0, 0).otherwise(at), F.to_date("o_orderdate"), "Europe/Rome")
    rows = A.table(spark, sf_dir, "orders").select("o_orderkey", first.alias("first_day"), last.alias("last_day"))
    day = F.when(F.col("o_orderkey") % 4 == 0, " ").otherwise("1996-06-01")
    return rows.withColumn("in_range", S.day_in_range(day, F.col("first_day"), F.col("last_day")))


_MODES = """
    m AS (SELECT user_id, coalesce(list(event_type ORDER BY event_id) FILTER (WHERE event_id % 2 = 0), []) AS old, coalesce(list(event_type ORDER BY event_id) FILTER (WHERE event_id % 2 = 1), []) AS new FROM events GROUP BY 1)"""


def _modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = A.table(spark, sf_dir, "events")
    row = F.struct("event_id", "event_type")
    half = lambda p: F.transform(F.array_sort(F.collect_list(F.when(F.col("event_id") % 2 == p, row))), lambda r: r["event_type"])
    return events.groupBy("user_id").agg(half(0).alias("old"), half(1).alias("new"))


@_query(f"""WITH {_MODES}
    SELECT user_id, array_to_string([x FOR x IN old IF NOT list_contains(new, x)], ',') AS gone, array_to_string([x FOR x IN new IF NOT list_contains(old, x)], ',') AS added FROM m""")
def mode_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _modes(spark, sf_dir).select("user_id", F.array_join(D.removed(F.col("old"), F.col("new")), ",").alias("gone"), F.array_join(D.removed(F.col("new"), F.col("old")), ",").alias("added"))


@_query(f"""WITH {_MODES}
    SELECT user_id, mode, CASE WHEN list_contains(new, mode) AND NOT list_contains(old, mode) THEN true WHEN list_contains(old, mode) AND NOT list_contains(new, mode) THEN false END AS visible
    FROM m, (VALUES ('view'), ('purchase')) AS o(mode)""")
def overlay_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _modes(spark, sf_dir).withColumn("mode", F.explode(F.array(F.lit("view"), F.lit("purchase"))))
    none = F.lit(None).cast("string")
    return rows.select("user_id", "mode", D.overlay_change(F.col("mode"), none, F.col("old"), F.col("new"), none, none).alias("visible"))


@_query("""
    SELECT l_orderkey, l_linenumber, 'docked' AS kind FROM lineitem WHERE l_returnflag <> 'A' AND l_linestatus = 'F'
    UNION ALL SELECT l_orderkey, l_linenumber, 'floating' FROM lineitem WHERE l_linestatus = 'O' AND l_quantity > 20""")
def vehicle_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = A.table(spark, sf_dir, "lineitem")
    floating = F.when(F.col("l_returnflag") == "A", True).when(F.col("l_returnflag") == "N", False)  # else unknown
    docked = lines.filter(F.col("l_linestatus") == "F").filter(~S.truthy(floating))
    loose = lines.filter((F.col("l_linestatus") == "O") & (F.col("l_quantity") > 20))
    return relate.union_all(docked.select("l_orderkey", "l_linenumber", F.lit("docked").alias("kind")), loose.select("l_orderkey", "l_linenumber", F.lit("floating").alias("kind")))


_FEATURE = """
    f AS (SELECT p_partkey, ['BUS', 'RAIL', 'BUS,RAIL', 'RAIL,BUS', 'TRAM'][p_partkey % 5 + 1] AS type, p_name AS name, 'P' || p_size::VARCHAR AS platform,
                 CASE p_partkey % 4 WHEN 0 THEN '[]' WHEN 1 THEN '["r"]' WHEN 2 THEN '' END AS routes, 9 + p_partkey % 11 AS zoom, ['BICYCLE', 'CAR', 'BICYCLE,CAR', 'CAR,BICYCLE', '', 'SCOOTER'][p_size % 6 + 1] AS ff,
                 CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS operative, CASE WHEN p_size % 5 <> 0 THEN p_size % 4 END AS vehicles,
                 CASE WHEN p_size % 2 = 0 THEN p_size % 3 END AS cars, CASE WHEN p_size % 3 = 0 THEN p_size % 5 END AS bicycles FROM part)"""


@_query(f"""WITH {_FEATURE}, g AS (SELECT *, CASE ff WHEN 'BICYCLE' THEN 'bicycle-icon' WHEN '' THEN 'bicycle-icon' WHEN 'SCOOTER' THEN 'bicycle-icon' ELSE 'car-icon' END AS base FROM f)
    SELECT p_partkey, CASE WHEN operative AND vehicles > 0 THEN base || '-available' WHEN operative = false OR coalesce(vehicles, 0) <= 0 THEN base || '-unavailable' ELSE base END AS rental_icon,
           CASE WHEN cars > 0 OR bicycles > 0 THEN 'parking-available-icon' ELSE 'parking-unavailable-icon' END AS parking_icon,
           CASE type WHEN 'BUS' THEN 'bus-icon' ELSE 'rail-icon' END AS stop_icon, CASE type WHEN 'RAIL' THEN 0.15 ELSE 0.1 END::DOUBLE AS stop_size, ff <> '' AS rental_shown,
           CASE ff WHEN 'BICYCLE' THEN 'bikes' WHEN 'CAR' THEN 'cars' ELSE 'vehicles' END AS unit, CASE WHEN vehicles > 0 THEN 1.0 ELSE 0.3 END::DOUBLE AS opacity FROM g""")
def style_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return A.features(spark, sf_dir).select(
        "p_partkey",
        D.rental_icon(c("formFactors"), c("operative"), c("vehiclesAvailable")).alias("rental_icon"),
        D.parking_icon(c("`capacity.carPlaces`"), c("`capacity.bicyclePlaces`")).alias("parking_icon"),
        D.match(c("type"), D.STOP_ICONS, "rail-icon").alias("stop_icon"),
        D.match(c("type"), D.STOP_SIZES, 0.1).alias("stop_size"),
        D.rental_shown(c("formFactors")).alias("rental_shown"),
        D.rental_unit(c("formFactors")).alias("unit"),
        D.charger_opacity(c("vehiclesAvailable")).alias("opacity"),
    )


@_query(f"""WITH {_FEATURE}
    SELECT p_partkey, CASE WHEN zoom >= 17 THEN platform WHEN zoom >= 16 THEN '' ELSE name END AS stop_label,
           CASE WHEN zoom >= 16 THEN platform WHEN type IN ('RAIL,BUS', 'BUS,RAIL') THEN name ELSE '' END AS station_label, CASE WHEN zoom >= 17 THEN name ELSE '' END AS name_label,
           CASE WHEN type IN ('RAIL', 'BUS,RAIL', 'RAIL,BUS') THEN 1 ELSE 5 END AS size_class, zoom::INT AS zoom
    FROM f WHERE routes = '["r"]' AND zoom >= CASE WHEN type IN ('RAIL', 'BUS,RAIL', 'RAIL,BUS') THEN 1 ELSE 15 END""")
def zoom_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    rows = A.features(spark, sf_dir).filter(D.has_routes(c("routes")) & D.shown_at_zoom(c("type"), c("zoom")))
    return rows.select(
        "p_partkey",
        D.stop_label(c("zoom"), c("name"), c("platform")).alias("stop_label"),
        D.station_label(c("zoom"), c("type"), c("name"), c("platform")).alias("station_label"),
        D.name_label(c("zoom"), c("name")).alias("name_label"),
        F.when(D.match(c("type"), D.STATION_MIN_ZOOM, 15) == 1, 1).otherwise(5).alias("size_class"),
        "zoom",
    )


@_query(f"""WITH {_FEATURE} SELECT p_partkey, type, CASE type WHEN 'RAIL,BUS' THEN 1 WHEN 'BUS,RAIL' THEN 1 WHEN 'RAIL' THEN 5 ELSE 10 END AS priority FROM f""")
def draw_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.features(spark, sf_dir).select("p_partkey", "type")
    return D.by_priority(rows, "type").withColumn("priority", D.match(F.col("type"), D.STATION_SORT, 10))


@_query("SELECT event_id, event_type, CASE event_type WHEN 'view' THEN 'Bus' WHEN 'click' THEN 'Funicolar' WHEN 'purchase' THEN 'CarSharing' END AS icon FROM events")
def mode_icons(spark: SparkSession, sf_dir: str) -> DataFrame:
    mode = D.match(F.col("event_type"), {"view": "TRANSIT", "click": "Gondola", "purchase": "CAR_RENT"}, F.lit("tram"))
    return A.table(spark, sf_dir, "events").select("event_id", "event_type", D.mode_icon(mode).alias("icon"))


@_query("SELECT p_partkey, p_type FROM part WHERE p_type IN (SELECT DISTINCT p_type FROM part WHERE p_type LIKE '%STEEL' OR p_type LIKE '%BRASS') OR p_size = 7 OR p_size = 21")
def tag_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    material = F.element_at(F.split("p_type", " "), -1)
    tags = F.create_map(F.lit("material"), material, F.lit("size"), F.col("p_size").cast("string"))
    return A.table(spark, sf_dir, "part").filter(D.tagged(tags, {"material": ["STEEL", "BRASS"], "size": ["7", "21"]})).select("p_partkey", "p_type")


@_query("SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 3 <> 0 THEN 'a' ELSE 'b' END AS side FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0")
def merge_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = A.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return relate.merge_distinct(orders.filter("o_orderkey % 3 <> 0").withColumn("side", F.lit("a")), orders.filter("o_orderkey % 2 = 0").withColumn("side", F.lit("b")), ["o_orderkey"])


@_query("SELECT event_id FROM events WHERE epoch((SELECT max(ts) FROM events)) - epoch(ts) > 259200")
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = A.table(spark, sf_dir, "events").select("event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("modified"))  # with fractions, as epoch() has them
    now = events.agg(F.max("modified").alias("now"))
    return events.join(F.broadcast(now)).filter(S.is_older(F.col("modified"), F.col("now"), 3 * 86_400)).select("event_id")


@_query("""
    WITH p AS (SELECT *, user_id % 10 AS poll, user_id % 10 <> 9 AND NOT (event_type = 'click' AND user_id % 10 = 8) AS ok FROM events)
    SELECT event_id, event_type, poll FROM p WHERE ok AND poll = (SELECT max(poll) FROM p AS q WHERE q.event_type = p.event_type AND q.ok)""")
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    poll = F.col("user_id") % 10
    polls = A.table(spark, sf_dir, "events").select("event_id", "event_type", poll.alias("poll"), ((poll != 9) & ~((F.col("event_type") == "click") & (poll == 8))).alias("ok"))
    return latest(polls, "event_type").select("event_id", "event_type", "poll")


@_query("SELECT c_custkey, CASE WHEN n_regionkey = 0 THEN c_nationkey::VARCHAR ELSE n_name END AS label FROM customer JOIN nation ON n_nationkey = c_nationkey")
def label_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    companies = A.table(spark, sf_dir, "nation").filter("n_regionkey <> 0")
    rows = relate.first_match(A.table(spark, sf_dir, "customer"), companies, F.col("c_nationkey"), "n_nationkey", "n_nationkey", "n_name", name="label")
    return rows.select("c_custkey", F.coalesce("label", F.col("c_nationkey").cast("string")).alias("label"))


@_query("""
    WITH a AS (SELECT c_custkey, radians(46.0 + (c_custkey % 1210) / 1000.0) AS p, 10.0 + (c_custkey % 2810) / 1000.0 AS l FROM customer),
    b AS (SELECT s_suppkey, radians(46.0 + (s_suppkey * 37 % 1210) / 1000.0 + 0.0004) AS q, 10.0 + (s_suppkey * 53 % 2810) / 1000.0 + 0.0003 AS m FROM supplier)
    SELECT c_custkey, s_suppkey FROM a, b WHERE 2 * 6371000 * asin(sqrt(least(1.0, pow(sin((q - p) / 2), 2) + cos(p) * cos(q) * pow(sin(radians(m - l) / 2), 2)))) <= 500""")
def vicinity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    a = A.table(spark, sf_dir, "customer").select("c_custkey", (F.lit(46.0) + (k % 1210) / 1000.0).alias("lat"), (F.lit(10.0) + (k % 2810) / 1000.0).alias("lon"))
    b = A.table(spark, sf_dir, "supplier").select("s_suppkey", (F.lit(46.0) + (s * 37 % 1210) / 1000.0 + 0.0004).alias("lat"), (F.lit(10.0) + (s * 53 % 2810) / 1000.0 + 0.0003).alias("lon"))
    return geo.within(a, b, 500).select("c_custkey", F.col("other_s_suppkey").alias("s_suppkey"))


@_query("""
    SELECT p_partkey, lower(hex(p_brand)) AS hex, 'v' || p_size::VARCHAR || '.2' AS version, trim(p_name) AS name, CASE WHEN p_size > 25 THEN 'yes' ELSE 'no' END AS large,
           'http://x/' || strftime(DATE '2024-01-31', '%Y%m%d') || '.zip' AS url, regexp_replace(p_type, '^([^ ]*) ', '\\1/') AS type FROM part""")
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sources.catalogue import dated_url

    c = F.col
    padded = F.concat(F.lit("\t "), c("p_name"), F.lit(" \n"))
    file = F.concat(F.lit("a converter-0.1.jar converter-"), c("p_size").cast("string"), F.lit(".2.jar"))
    return A.table(spark, sf_dir, "part").select(
        "p_partkey",
        S.char_hex(c("p_brand")).alias("hex"),
        F.concat(F.lit("v"), S.version_in(file, "converter")).alias("version"),
        S.trim_space(padded).alias("name"),
        S.yes_no(c("p_size") > 25).alias("large"),
        dated_url("http://x/{date}.zip", F.lit("2024-01-31").cast("date")).alias("url"),
        S.replace_first(c("p_type"), " ", "/").alias("type"),
    )


@_query("""
    SELECT CASE c_custkey % 3 WHEN 0 THEN 'BZ' WHEN 1 THEN 'ME' ELSE 'PAPIN' END AS region_id, CASE c_custkey % 3 WHEN 0 THEN 'Bolzano - Bozen' WHEN 1 THEN 'Merano - Meran' ELSE 'Papin - Rent a bike' END AS name, count(*) AS stations
    FROM customer GROUP BY 1, 2""")
def region_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = F.get(F.array(*[F.lit(r) for r, _ in feeds.REGIONS]), (F.col("c_custkey") % 3).cast("int"))
    counts = A.table(spark, sf_dir, "customer").groupBy(region.alias("region_id")).agg(F.count(F.lit(1)).alias("stations"))
    return feeds.regions(spark).join(counts, "region_id")


@_query("""
    SELECT user_id, CASE WHEN n > 0 THEN lat END AS lat, state, CASE WHEN state = 'view' THEN 0.3 ELSE 1.0 END::DOUBLE AS opacity FROM (
        SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS n, arg_max(event_id % 50 + 0.5, event_id) FILTER (WHERE event_type = 'click')::DOUBLE AS lat,
               arg_max('view', event_id) FILTER (WHERE event_type = 'view') AS state FROM events GROUP BY 1) WHERE n > 0""")
def current_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    at = F.concat((i % 50).cast("string"), F.lit(",5"))
    value = F.when(F.col("event_type") == "click", F.to_variant_object(F.struct(at.alias("lat"), at.alias("lon")))).otherwise(F.parse_json(F.concat(F.lit('"'), F.col("event_type"), F.lit('"'))))
    name = F.when(F.col("event_type") == "click", "position").when(F.col("event_type") == "view", "state").otherwise("other")
    rows = A.table(spark, sf_dir, "events").select(F.col("user_id").alias("scode"), F.lit("x").alias("sname"), F.lit("y").alias("prlineage"), name.alias("tname"), value.alias("mvalue"), i.alias("ordinal"))
    out = poi.current_vehicles(rows)
    return out.select(F.col("Phone").alias("user_id"), "lat", F.col("State").alias("state"), D.opacity(F.col("State") == "view").alias("opacity"))


@_query("""
    WITH r AS (SELECT o_custkey AS k, arg_min(o_orderkey % 40, o_orderkey) AS a FROM orders GROUP BY 1),
    op AS (SELECT n_nationkey AS a, n_name AS name FROM nation)
    SELECT c_custkey, name AS operator FROM customer LEFT JOIN r ON k = c_custkey LEFT JOIN op USING (a)""")
def stop_operator(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    route = F.struct(key.alias("k"), F.struct((key % 40).cast("string").alias("gtfsId")).alias("agency"))
    routes = A.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(route)).alias("routes"))
    stops = A.table(spark, sf_dir, "customer").select("c_custkey").join(routes, F.col("c_custkey") == F.col("o_custkey"), "left")
    operators = A.table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("agencyId"), F.col("n_name").alias("name"), F.col("n_nationkey").alias("ordinal"))
    return poi.with_operator(stops, operators).select("c_custkey", "operator")


@_query("""
    SELECT user_id, CASE event_type WHEN 'view' THEN 'green' WHEN 'click' THEN NULL ELSE 'plain' END AS branding, CASE event_type WHEN 'view' THEN 'Views' WHEN 'click' THEN 'Clicks' ELSE 'Journeys' END AS title, count(*) AS n
    FROM events GROUP BY ALL""")
def brand_by_host(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = {"view": {"branding": "green", "title": "Views"}, "click": {"title": "Clicks"}}
    own = lambda field, default: D.branded(F.col("event_type"), brands, field, F.lit(default)).alias(field)
    return A.table(spark, sf_dir, "events").groupBy("user_id", own("branding", "plain"), own("title", "Journeys")).agg(F.count(F.lit(1)).alias("n"))


@_query("""
    SELECT l_orderkey, l_linenumber, floor(l_extendedprice / 100 + 0.5)::DOUBLE AS power, CASE WHEN l_linenumber = 3 THEN NULL WHEN l_linenumber = 1 THEN 0 ELSE 2 END::INT AS n_types,
           CASE WHEN l_linenumber NOT IN (1, 3) THEN l_returnflag END AS first_type FROM lineitem""")
def charger_popup(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    text = F.when(n == 3, "").when(n == 1, "[]").otherwise(F.to_json(F.array("l_returnflag", "l_linestatus")))
    types = S.parsed_property(F.col("types"), "array<string>")
    rows = A.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", A.once(text).alias("types"))
    return rows.select("l_orderkey", "l_linenumber", S.rounded(F.col("l_extendedprice") / 100).alias("power"), F.when(types.isNotNull(), F.size(types)).alias("n_types"), F.get(types, F.lit(0)).alias("first_type"))


@_query("""
    SELECT r_regionkey, 'http://tiles/' || coalesce(string_agg(n_name || ',' || 'x' || n_nationkey::VARCHAR, ',' ORDER BY n_nationkey) FILTER (WHERE n_nationkey % 3 = 1), '') || '/tilejson.json' AS url
    FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY 1""")
def overlay_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    layers = F.when(key % 3 != 2, F.array(F.struct(F.col("n_name").alias("type")), F.struct(F.concat(F.lit("x"), key.cast("string")).alias("type"))))
    overlay = F.struct(key.alias("k"), F.struct(F.when(key % 3 == 1, "otp2").when(key % 3 == 2, "otp2").otherwise("micromobility").alias("type"), layers.alias("layers")).alias("o"))
    overlays = A.table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.transform(F.array_sort(F.collect_list(overlay)), lambda x: x["o"]).alias("overlays"))
    rows = A.table(spark, sf_dir, "region").join(overlays, F.col("r_regionkey") == F.col("n_regionkey"), "left")
    return rows.select("r_regionkey", D.tile_url(F.lit("http://tiles"), D.layer_types(F.col("overlays"))).alias("url"))


@_query(f"""WITH {_FEATURE}
    SELECT p_partkey, p_partkey % 5 = 0 AND p_partkey % 10 <> 0 AS dot, platform = 'P7' AND routes = '["r"]' AND routes IS NOT NULL AS highlighted, p_partkey % 6 <> 0 AND coalesce(routes = '["r"]', false) AS platform_shown FROM f""")
def stop_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    live = F.when(key % 5 == 0, key % 10 != 0)
    platform = F.when(key % 6 != 0, F.col("platform"))
    return A.features(spark, sf_dir).select(
        "p_partkey", D.live_dot_shown(live).alias("dot"), D.highlighted(F.col("platform"), F.lit("P7"), F.col("routes")).alias("highlighted"), D.platform_shown(platform, F.col("routes")).alias("platform_shown")
    )


@_query("SELECT p_partkey, coalesce(CASE WHEN p_size % 5 <> 0 THEN p_size % 4 END > 0, false) OR 9 + p_partkey % 11 >= 10 AS shown FROM part")
def charger_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.features(spark, sf_dir).select("p_partkey", D.charger_shown(F.col("vehiclesAvailable"), F.col("zoom")).alias("shown"))


@_query("""
    SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN s_acctbal ELSE s_suppkey + 0.5 END::DOUBLE AS lat, CASE WHEN s_suppkey % 4 = 0 THEN s_acctbal ELSE s_suppkey + 0.25 END::DOUBLE AS lon,
           CASE WHEN s_suppkey % 5 = 0 THEN s_name ELSE 'place' END AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'raw' WHEN s_nationkey % 2 = 0 THEN 'stop' ELSE 'feature' END AS shape FROM supplier""")
def place_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, own = F.col("s_suppkey"), lambda m, c: F.when(F.col("s_suppkey") % m == 0, F.col(c))
    at = D.place_location(own(3, "s_acctbal"), own(4, "s_acctbal"), F.array((key + 0.25).cast("double"), (key + 0.5).cast("double")), own(5, "s_name"), F.lit("place"))
    source = F.when(F.col("s_nationkey") % 2 == 0, D.STOP_SOURCE).otherwise("other")
    shape = D.poi_shape(key % 2 != 0, source, F.lit("raw"), F.lit("stop"), F.lit("feature"))
    return A.table(spark, sf_dir, "supplier").select("s_suppkey", at.alias("at"), shape.alias("shape")).select("s_suppkey", "at.*", "shape")


@_query("""
    SELECT 'tourism' AS source, 'venue' AS layer, p_partkey::VARCHAR AS id, 46.5::DOUBLE AS lat, 11.5::DOUBLE AS lon, CASE WHEN p_size % 2 = 0 THEN p_name END AS name, CASE WHEN p_size % 3 = 0 THEN p_brand END AS name_de, NULL::VARCHAR AS name_en, NULL::VARCHAR AS name_fr,
           CASE WHEN p_size % 2 = 0 THEN p_name END AS name_it, '["touristic:' || replace(p_type, ' ', '_') || '"]' AS category_json,
           CASE WHEN p_size % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN p_size % 3 = 0 THEN 1 ELSE 0 END AS n_titles, p_type AS tag FROM part""")
def import_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    title = lambda m, c: F.when(size % m == 0, F.struct(F.col(c).alias("Title")))
    detail = F.map_filter(F.create_map(F.lit("it"), title(2, "p_name"), F.lit("de"), title(3, "p_brand")), lambda k, v: v.isNotNull())
    places = A.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("Id"), F.struct(F.struct(F.lit(46.5).alias("Latitude"), F.lit(11.5).alias("Longitude")).alias("position")).alias("GpsPoints"), detail.alias("Detail"), F.array(F.struct(F.col("p_type").alias("Id"))).alias("Tags")
    )
    record = F.from_json("addendum_json_poi", "Detail map<string, struct<Title:string>>, Tags array<struct<Id:string>>")
    rows = poi.touristic_rows(places, "tourism").withColumn("record", record)
    return rows.select(*[c for c in rows.columns if c not in ("addendum_json_poi", "record")], F.size("record.Detail").alias("n_titles"), F.get("record.Tags", F.lit(0))["Id"].alias("tag"))


@_query("""
    WITH c AS (SELECT c_custkey, ['bz', 'me', 'papin'][c_custkey % 3 + 1] AS context, CASE WHEN c_nationkey % 2 = 0 THEN '1' ELSE '2.1' END AS version FROM customer),
    f AS (SELECT context, version, feed FROM (VALUES ('bz'), ('me'), ('papin')) a(context), (VALUES ('1'), ('2.1')) b(version),
          (VALUES ('system_information'), ('station_information'), ('station_status'), ('system_regions'), ('system_hours'), ('gbfs_versions'), ('vehicle_types'), ('free_bike_status')) d(feed)
          WHERE (feed NOT IN ('gbfs_versions', 'vehicle_types') OR version = '2.1') AND (feed <> 'free_bike_status' OR context = 'me'))
    SELECT context, version, feed, 'https://feeds/' || context || '/' || version || '/' || feed || '.json' AS url, count(*) AS stations FROM c JOIN f USING (context, version) GROUP BY ALL""")
def feed_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    version = F.when(F.col("c_nationkey") % 2 == 0, "1").otherwise("2.1")
    counts = A.table(spark, sf_dir, "customer").groupBy(F.get(F.array(*map(F.lit, feeds.CONTEXTS)), (F.col("c_custkey") % 3).cast("int")).alias("context"), version.alias("version")).agg(F.count(F.lit(1)).alias("stations"))
    base = feeds.base_url({"host": "feeds:80", "x-forwarded-host": "feeds", "x-forward-proto": "https"})
    lists = [feeds.feed_list(spark, c, v, base).select(F.lit(c).alias("context"), F.lit(f"{v:g}").alias("version"), F.col("name").alias("feed"), "url") for c in feeds.CONTEXTS for v in (1, feeds.VERSION)]
    return relate.union_all(*lists).join(counts, ["context", "version"])


@_query("""
    WITH c AS (SELECT ['bz', 'me', 'papin'][c_custkey % 3 + 1] AS context, count(*) AS stations FROM customer GROUP BY 1)
    SELECT context, 'odh_bikesharing_' || context AS system_id, CASE context WHEN 'papin' THEN NULL WHEN 'bz' THEN 'ios' ELSE 'android' END AS app_platform, CASE context WHEN 'papin' THEN 0 ELSE 7 END::INT AS n_days,
           2::BIGINT AS n_versions, 2::BIGINT AS n_types, stations FROM c""")
def system_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = A.table(spark, sf_dir, "customer").groupBy(F.get(F.array(*map(F.lit, feeds.CONTEXTS)), (F.col("c_custkey") % 3).cast("int")).alias("context")).agg(F.count(F.lit(1)).alias("stations"))
    apps = {"bz": {"android": "a", "ios": "i"}, "me": {"android": "a"}, "papin": {}}

    def system(c: str) -> DataFrame:
        days = feeds.system_hours(spark, c).agg(F.coalesce(F.max(F.size("days")), F.lit(0)).alias("n_days"))
        versions = feeds.versions(spark, c, feeds.VERSION, "http://feeds").agg(F.count(F.lit(1)).alias("n_versions"))
        types = feeds.vehicle_types(spark, c).agg(F.count(F.lit(1)).alias("n_types"))
        one = feeds.system_information(spark, c, **apps[c]).select(F.lit(c).alias("context"), "system_id", "app_platform")
        return one.join(days).join(versions).join(types)  # a row each

    return relate.union_all(*map(system, feeds.CONTEXTS)).join(counts, "context")


@_query("""
    SELECT n_nationkey, r_name, CASE r_regionkey % 3 WHEN 0 THEN 120 WHEN 1 THEN 600 ELSE 30 END::INT AS polling_interval, CASE r_regionkey % 3 WHEN 1 THEN NULL ELSE 'feeds.example' END AS host, 443 AS port
    FROM nation JOIN region ON r_regionkey = n_regionkey""")
def layered_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .config import endpoints

    service = {"e0": {"polling_interval": 120}, "e1": {"host": None}, "e2": {"polling_interval": 30}, "default": {"polling_interval": 600}}
    merged = endpoints(service, {"default": {"polling_interval": 5, "host": "feeds.example", "port": 443}})
    rows = spark.createDataFrame([(k, v["polling_interval"], v["host"], v["port"]) for k, v in merged.items()], "endpoint string, polling_interval int, host string, port int")
    regions = A.table(spark, sf_dir, "region").withColumn("endpoint", F.concat(F.lit("e"), (F.col("r_regionkey") % 3).cast("string"))).join(rows, "endpoint")
    return A.table(spark, sf_dir, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name", "polling_interval", "host", "port")


_METRES = "2 * 6371000 * asin(sqrt(least(pow(sin((radians(b.lat) - radians(a.lat)) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2), 1.0)))"


@_query(f"""
    WITH a AS (SELECT c_custkey, {_POINT.format('c_custkey')} FROM customer), b AS (SELECT s_suppkey, {_POINT.format('s_suppkey * 7')} FROM supplier WHERE s_nationkey % 4 > 0),
    d AS (SELECT c_custkey, s_suppkey, round({_METRES}, 3) AS metres FROM a, b),
    r AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY metres, s_suppkey) AS rank FROM d)
    SELECT c_custkey, rank::INT AS rank, s_suppkey FROM r WHERE rank <= 6""")
def nearest_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = A.table(spark, sf_dir, "customer").select("c_custkey", A.point("c_custkey").alias("p")).select("c_custkey", F.col("p.y").alias("lat"), F.col("p.x").alias("lon"))
    stops = A.table(spark, sf_dir, "supplier").filter(D.nearby_shown(F.lit("Stop"), F.col("s_nationkey") % 4, ["Stop"])).withColumn("k", F.col("s_suppkey") * 7)
    stops = stops.select("s_suppkey", A.point("k").alias("p")).select("s_suppkey", F.col("p.y").alias("lat"), F.col("p.x").alias("lon"))
    return nearest(points, stops, 6, key="c_custkey", place="s_suppkey").drop("metres")


_STAR = [(-1.0, -1.0), (1.0, -0.8), (0.3, 0.0), (0.9, 1.0), (-0.7, 0.8), (-1.0, -1.0)]


@_query(f"""
    WITH corner AS (SELECT n_nationkey AS k, i, (n_nationkey % 5 - 2) * 0.06 + x * ((1 + n_nationkey % 3) * 0.04) AS x, (n_nationkey // 5 - 2) * 0.06 + y * ((1 + n_nationkey % 3) * 0.04) AS y
                    FROM nation, (VALUES {', '.join(f'({i}, {x}::DOUBLE, {y}::DOUBLE)' for i, (x, y) in enumerate(_STAR))}) AS c(i, x, y)),
    edge AS (SELECT a.k, a.x AS ax, a.y AS ay, b.x AS qx, b.y AS qy FROM corner a JOIN corner b ON b.k = a.k AND b.i = a.i + 1),
    p AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings)
    SELECT vec_id, k AS n_nationkey FROM p, edge WHERE (ay > y) <> (qy > y) AND x < (qx - ax) * (y - ay) / (qy - ay) + ax GROUP BY 1, 2 HAVING count(*) % 2 = 1""")
def rings_by_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_nationkey")
    size = (1 + n % 3) * F.lit(0.04)
    corners = F.array(*[F.array((n % 5 - 2) * F.lit(0.06) + F.lit(x) * size, (F.floor(n / 5) - 2) * F.lit(0.06) + F.lit(y) * size) for x, y in _STAR])
    rings = A.table(spark, sf_dir, "nation").select("n_nationkey", corners.alias("ring"))
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    points = A.table(spark, sf_dir, "embeddings").select("vec_id", at(0).alias("x"), at(1).alias("y"))
    return points_in_rings(points, rings, ring_id="n_nationkey", world=(-2.0, -2.0, 4.0)).select("vec_id", "n_nationkey")


def _extracts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as nodes, customers as ways, nations and regions as relations, in two extracts that overlap; some nodes are in neither."""
    ref = lambda kind, key: F.struct(F.lit(kind).alias("kind"), F.col(key).cast("long").alias("id"), F.lit("").alias("role"))
    none = F.lit(None).cast("array<struct<kind:string,id:long,role:string>>")
    orders, customers = A.table(spark, sf_dir, "orders"), A.table(spark, sf_dir, "customer")
    nodes = orders.filter("o_orderstatus <> 'P'").select(F.lit("node").alias("kind"), F.col("o_orderkey").cast("long").alias("id"), F.create_map(F.lit("class"), F.col("o_orderpriority")).alias("tags"), none.alias("refs"))
    of = orders.groupBy("o_custkey").agg(F.collect_list(ref("node", "o_orderkey")).alias("refs"))
    ways = customers.join(of, F.col("c_custkey") == F.col("o_custkey"), "left").select(F.lit("way").alias("kind"), F.col("c_custkey").cast("long").alias("id"), F.create_map(F.lit("highway"), F.col("c_mktsegment")).alias("tags"), "refs")
    inner = customers.groupBy("c_nationkey").agg(F.collect_list(ref("way", "c_custkey")).alias("refs"))
    nations = A.table(spark, sf_dir, "nation").join(inner, F.col("n_nationkey") == F.col("c_nationkey"), "left").select(F.lit("relation").alias("kind"), F.col("n_nationkey").cast("long").alias("id"), F.create_map(F.lit("name"), F.col("n_name")).alias("tags"), "refs")
    outer = A.table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.collect_list(ref("relation", "n_nationkey")).alias("refs"))
    regions = A.table(spark, sf_dir, "region").join(outer, F.col("r_regionkey") == F.col("n_regionkey"), "left").select(F.lit("relation").alias("kind"), (F.col("r_regionkey") + 1_000).cast("long").alias("id"), F.create_map(F.lit("name"), F.col("r_name")).alias("tags"), "refs")
    every = relate.union_all(nodes, ways, nations, regions)
    side = lambda name: every.select("kind", "id", F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("lon"), F.map_concat("tags", F.create_map(F.lit("extract"), F.lit(name))).alias("tags"), "refs")
    return side("first").filter("id % 3 <> 0"), side("second").filter("id % 2 = 0 or id % 3 = 0")


_MAP = """
    chosen AS (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') OR c_nationkey IN (SELECT n_nationkey FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'ASIA')),
    parts AS (SELECT 'relation' AS kind, r_regionkey + 1000 AS id, (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey) AS n FROM region WHERE r_name = 'ASIA'
        UNION ALL SELECT 'relation', n_nationkey, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'ASIA'
        UNION ALL SELECT 'way', c_custkey, coalesce(n, 0) FROM chosen LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey
        UNION ALL SELECT 'node', o_orderkey, 0 FROM orders WHERE o_orderstatus <> 'P' AND o_custkey IN (SELECT c_custkey FROM chosen))"""


@_query(f"""
    WITH {_MAP} SELECT kind, id::BIGINT AS id, CASE WHEN id % 3 <> 0 THEN 'first' ELSE 'second' END AS extract, n::BIGINT AS n_refs FROM parts""")
def map_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = elements.merge(*_extracts(spark, sf_dir))
    chosen = elements.tagged(every, "way", "highway", ["BUILDING", "MACHINERY"]).unionByName(elements.tagged(every, "relation", "name", ["ASIA"]))
    return elements.completed(every, chosen).select("kind", "id", F.col("tags")["extract"].alias("extract"), F.coalesce(F.size("refs"), F.lit(0)).cast("long").alias("n_refs"))


@_query("""
    SELECT 'node' AS kind, o_orderkey::BIGINT AS id FROM orders WHERE o_orderstatus = 'P' AND o_custkey IN (SELECT c_custkey FROM customer)""")
def map_dangling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return elements.dangling(elements.merge(*_extracts(spark, sf_dir)))


@_query("""
    SELECT c_custkey, c_name, CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS c_acctbal, 'a "q", ' || c_mktsegment AS note, row_number() OVER (ORDER BY c_name DESC) - 1 AS ordinal FROM customer""")
def feed_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as one feed document, written by many tasks, and read back."""
    rows = A.table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal").cast("double")).alias("c_acctbal"), F.concat(F.lit('a "q", '), "c_mktsegment").alias("note"))
    path = f"{scratch(spark, 'feed')}/feed.json"
    last = rows.withColumn("o", F.translate("c_name", "0123456789", "9876543210"))
    documents.write_envelope(last, path, "stations", NOW, "2.1", order="o", keep_nulls=["c_acctbal"], without="o")
    kinds = {"c_custkey": "bigint", "c_acctbal": "double"}
    row = ",".join(f"{c}:{kinds.get(c, 'string')}" for c in rows.columns)
    whole = spark.read.schema(f"last_updated long, ttl int, version string, data struct<stations:array<struct<{row}>>>").json(path, multiLine=True)
    return whole.select(F.posexplode("data.stations").alias("ordinal", "row")).select("row.*", F.col("ordinal").cast("long"))


@_query("""
    SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN 'the "' || p_name || '"' || chr(10) || p_type ELSE CASE WHEN p_partkey % 2 = 0 THEN '' END END AS title, CASE WHEN p_size > 5 THEN p_retailprice END AS price FROM part""")
def csv_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as one CSV file with its header, written by many tasks, and read back: empty text and null stay apart."""
    key = F.col("p_partkey")
    title = F.when(key % 3 != 0, F.concat(F.lit('the "'), "p_name", F.lit('"\n'), "p_type")).when(key % 2 == 0, "")
    rows = A.table(spark, sf_dir, "part").select("p_partkey", title.alias("title"), F.when(F.col("p_size") > 5, F.col("p_retailprice").cast("double")).alias("price"))
    path = f"{scratch(spark, 'csv')}/parts.csv"
    documents.write_csv_file(rows, path, order="p_partkey")
    return documents.read_csv_file(spark, path, rows.schema)


@_query("""
    SELECT s_suppkey, s_name, CASE WHEN s_nationkey % 2 = 0 THEN s_acctbal END AS s_acctbal FROM supplier""")
def json_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = A.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.when(F.col("s_nationkey") % 2 == 0, F.col("s_acctbal").cast("double")).alias("s_acctbal"))
    path = f"{scratch(spark, 'array')}/rows.json"
    documents.write_array(rows, path, order="s_suppkey")
    return spark.read.schema(rows.schema).json(path, multiLine=True)


@_query("""
    SELECT 'feed' || (n_nationkey % 4)::VARCHAR || '.zip' AS archive, c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS name, CASE WHEN c_custkey % 5 <> 0 THEN c_custkey / 4.0 END::DOUBLE AS lat
    FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def archive_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as stops.txt of four archives, beside members that nobody reads, and read back as a table."""
    rows = A.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("feed"), (F.col("c_nationkey") % 4).cast("string"), F.lit(".zip")).alias("archive"), F.col("c_custkey"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")).alias("name"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey") / 4.0).alias("lat")
    )
    lines = rows.select("archive", F.lit("stops.txt").alias("member"), F.col("c_custkey").cast("long").alias("ordinal"), documents.csv_text(rows, ["c_custkey", "name", "lat"]).alias("value"))
    heads = lines.groupBy("archive", "member").agg(F.lit(-1).cast("long").alias("ordinal"), F.lit("c_custkey,name,lat").alias("value"))
    folder = scratch(spark, "archives")
    archives.write_archives(lines.unionAll(heads).unionAll(heads.withColumn("member", F.lit("readme.md"))), folder)
    back = archives.read_table(spark, folder, "stops.txt", "c_custkey long, name string, lat double")
    return back.select(F.element_at(F.split("archive", "/"), -1).alias("archive"), "c_custkey", "name", "lat")


@_query("""
    SELECT r_regionkey, n_nationkey, n_name FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey % 3 <> 1""")
def published_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second of two published versions of a table."""
    rows = A.table(spark, sf_dir, "nation").join(A.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("r_regionkey", "n_nationkey", "n_name")
    path = scratch(spark, "published")
    sinks.publish(rows, path, "poll-0")
    sinks.publish(rows.filter("n_nationkey % 3 <> 1"), path, "poll-1")
    return sinks.published(spark, path)


@_query("""
    SELECT o_orderkey, o_orderstatus AS status, (o_orderkey % 7)::BIGINT AS page FROM orders""")
def paged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as seven page documents, and their items read back from all pages."""
    rows = A.table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), (F.col("o_orderkey") % 7).cast("long").alias("page"))
    folder = scratch(spark, "pages")
    for page in range(7):
        documents.write_pieces(rows.filter(F.col("page") == page).select(documents.row_text(rows, without="page")), f"{folder}/{page}.json", f'{{"TotalPages":7,"CurrentPage":{page},"Items":[', ",", "]}")
    items = snapshots.read_items(spark, folder, "o_orderkey bigint, status string")
    return items.select("o_orderkey", "status", F.regexp_extract("page", r"(\d)\.json$", 1).cast("long").alias("page"))
