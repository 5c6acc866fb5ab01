"""Display rules."""

from pyspark.sql import functions as F

from tramline.functions import display as D

from .test_semantics import one


def lits(*xs):
    return F.array(*map(F.lit, xs)).cast("array<string>")


def test_steps_and_matches(spark):
    label = lambda z: D.stop_label(F.lit(z), F.lit("n"), F.lit("p"))
    assert one(spark, *[label(z) for z in (15, 16, 17, 20)]) == ["n", "", "p", "p"]
    assert one(spark, *[D.station_label(F.lit(10), F.lit(t), F.lit("n"), F.lit("p")) for t in ("BUS", "RAIL", "RAIL,BUS")]) == ["", "", "n"]
    assert one(spark, *[D.shown_at_zoom(F.lit(t), F.lit(z)) for t, z in (("BUS", 14), ("RAIL", 1), ("TRAM", 15))]) == [False, True, True]
    assert one(spark, *[D.has_routes(F.lit(r).cast("string")) for r in ("[]", "", None, '["x"]')]) == [False, False, False, True]


def test_icons(spark):
    icon = lambda f, o, n: D.rental_icon(F.lit(f), F.lit(o).cast("boolean"), F.lit(n).cast("int"))
    assert one(spark, icon("CAR", True, 2), icon("CAR", True, 0), icon("BICYCLE", False, 3), icon("BICYCLE,CAR", None, 1), icon("x", None, None)) == [
        "car-icon-available", "car-icon-unavailable", "bicycle-icon-unavailable", "car-icon", "bicycle-icon-unavailable"
    ]
    assert one(spark, *[D.mode_icon(F.lit(m).cast("string")) for m in ("BUS", "Gondola", "tram", None)]) == ["Bus", "Funicolar", None, None]
    assert one(spark, D.parking_icon(F.lit(None).cast("int"), F.lit(0)), D.parking_icon(F.lit(0), F.lit(3))) == ["parking-unavailable-icon", "parking-available-icon"]
    assert one(spark, D.taxi_opacity(F.lit(None).cast("string")), D.taxi_opacity(F.lit("OCCUPIED")), D.charger_opacity(F.lit(0)), D.charger_shown(F.lit(0), F.lit(9))) == [1.0, 0.3, 0.3, False]


def test_filters(spark):
    none = F.array().cast("array<string>")
    assert one(spark, D.known_types(lits("T2", "Unknown"), none), D.known_types(none, lits("unknown", None)), D.known_types(none, none), D.known_types(lits("T2"), lits(None))) == [False, False, True, True]
    shown = lambda k, n, a: D.nearby_shown(F.lit(k), F.lit(n).cast("int"), a)
    assert one(spark, shown("Stop", 0, None), shown("Stop", 2, ["Stop"]), shown("Park", None, ["Stop"]), shown("Park", None, None)) == [False, True, False, True]
    assert one(spark, D.removed(lits("a", "b", "a"), lits("b")))[0] == ["a", "a"]
    assert one(spark, D.fresh(F.lit(1.0), F.lit(2.0), F.lit(1.0), F.lit(None).cast("double"))) == [False]


def test_overlays(spark):
    change = lambda m, c, old, new, oc, nc: D.overlay_change(F.lit(m), F.lit(c).cast("string"), lits(*old), lits(*new), F.lit(oc).cast("string"), F.lit(nc).cast("string"))
    got = one(
        spark,
        change("BUS", None, ["WALK"], ["BUS"], None, None),
        change("BUS", None, ["BUS"], ["WALK"], None, None),
        change("BUS", None, ["BUS"], ["BUS"], None, None),
        change("CAR_RENT", "x", [], ["CAR_RENT"], None, "x,y"),
        change("CAR_RENT", "x", [], ["CAR_RENT"], None, "y"),
        change("CAR_RENT", "x", ["CAR_RENT"], [], "x", "x"),
        change("CAR_RENT", "x", ["CAR_RENT"], ["CAR_RENT"], "y", "x"),
        change("CAR_RENT", "x", ["CAR_RENT"], ["CAR_RENT"], "x", "y"),
        change("CAR_RENT", "x", ["CAR_RENT"], ["CAR_RENT"], "x", "x"),
    )
    assert got == [True, False, None, True, None, False, True, False, None]


def test_points_and_places(spark):
    p = lambda a: F.struct(F.lit(a).cast("double").alias("lat"), F.lit(9.0).alias("lon"))
    no = F.lit(None).cast("struct<lat:double,lon:double>")
    assert [x and x["lat"] for x in one(spark, D.nearby_point(no, no, p(0), p(4), p(5)), D.nearby_point(no, no, p(3), p(4), p(5)), D.nearby_point(no, no, no, no, no))] == [4.0, 3.0, None]
    place = D.place_location(F.lit(None).cast("double"), F.lit(0.0), F.array(F.lit(11.0), F.lit(46.0)), F.lit(None).cast("string"), F.lit("n"))
    assert one(spark, place)[0].asDict() == {"lat": 46.0, "lon": 0.0, "name": "n"}
