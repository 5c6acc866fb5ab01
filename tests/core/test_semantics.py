"""Rules for loosely typed data."""

from pyspark.sql import functions as F

from tramline.functions import geo
from tramline.functions import semantics as S


def one(spark, *columns):
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return list(row)


def v(text):
    return F.parse_json(F.lit(text))


def test_truthiness(spark):
    texts = ["0", "1", '""', '"a"', "null", "true", "false", "{}", "[]", "0.0"]
    assert one(spark, *[S.truthy_variant(v(t)) for t in texts]) == [False, True, False, True, False, True, False, True, True, False]
    o = v('{"a":null}')
    assert one(spark, S.truthy_variant(S.field(o, "b")), S.is_absent(S.field(o, "b")), S.is_json_null(S.field(o, "a")), S.is_json_null(S.field(o, "b"))) == [False, True, True, False]
    assert one(spark, S.or_null(F.lit(0)), S.or_null(F.lit(4)), S.or_else(F.lit(0), F.lit(7)), S.or_null(F.lit(""), "string")) == [None, 4, 7, None]


def test_equality(spark):
    loose = ["0", '"0"', '""', "false", "null", "1", '" "', '"x"']
    assert one(spark, *[S.loosely_equals(v(t), 0) for t in loose]) == [True, True, True, True, False, False, True, False]
    assert one(spark, *[S.strictly_equals(v(t), 1) for t in ("1", '"1"', "null", "true", "1.0")]) == [True, False, False, False, True]
    assert one(spark, *[S.to_number(v(t)) for t in ("null", '"12"', "true", '"x"', "3.5")]) == [0.0, 12.0, 1.0, None, 3.5]


def test_text(spark):
    assert one(spark, *[S.replace_first(F.lit(t), "_", "/") for t in ("A_B_C", "AB", "_", "A_")]) == ["A/B_C", "AB", "/", "A/"]
    assert one(spark, S.replace_first(F.lit("P:P:7"), "P:", "")) == ["P:7"]
    assert one(spark, S.trimmed_or_empty(F.lit("\t\n x  y \r\n")), S.trimmed_or_empty(F.lit(None).cast("string"))) == ["x  y", ""]
    assert one(spark, *[S.title_words(F.lit(t)) for t in ("SAN MARTINO", "neu-MARKT o'neil", "a  b", None)]) == ["San Martino", "Neu-markt O'neil", "A  B", None]
    assert one(spark, S.yes_no(F.lit(None).cast("boolean")), S.yes_no(F.lit(True))) == ["no", "yes"]
    assert one(spark, S.key_text(S.field(v("{}"), "a")), S.key_text(S.field(v('{"a":null}'), "a")), S.key_text(S.field(v('{"a":"T2"}'), "a"))) == ["undefined", "null", "T2"]
    assert one(spark, S.first_seen_keys(F.array(*map(F.lit, ["b", "10", "a", "2", "b", "01"]))))[0] == ["2", "10", "b", "a", "01"]
    assert one(spark, *[S.decimal_comma(F.lit(t)) for t in ("11,35", "46.5", "1,5,7", "x", " -2,5 E")]) == [11.35, 46.5, 1.5, None, -2.5]
    assert one(spark, S.slug("t:", F.lit("a b c")), S.char_hex(F.lit("Az")), S.version_in(F.lit("x-1.2.jar conv-3.4.5.jar"), "conv")) == ["t:a_b_c", "417a", "3.4.5"]


def test_opening_hours(spark):
    h = lambda *p: S.opening_hours(*[F.lit(x).cast("string") for x in p])
    got = one(spark, h("08:00", "19:00", "12:00", "14:00"), h("08:00", "19:00", "", "14:00"), h("", "19:00", "12:00", "14:00"), h(None, "1", None, None))
    assert got == ["Mo-Su 08:00-12:00, Mo-Su 14:00-19:00", "Mo-Su 08:00-19:00", None, None]


def test_calendar(spark):
    day = F.lit("2024-05-01").cast("date")
    first, last = S.calendar_bounds(F.lit(0), F.lit(0), day, "Europe/Rome")
    start, end = S.calendar_bounds(F.lit(1704063600), F.lit(1704150000), day, "Europe/Rome")  # midnights in Rome
    assert one(spark, first, last, start, end) == ["2024-01-01", "2025-12-31", "2024-01-01", "2024-01-01"]
    assert one(spark, *[S.day_in_range(F.lit(d), F.lit("2024-01-01"), F.lit("2024-02-01")) for d in ("2024-01-01", "2024-02-01", "2024-02-02", " ", None)]) == [True, True, False, False, False]


def test_boxes(spark):
    import pytest

    assert geo.parse_bbox(None) is None and geo.parse_bbox("") is None
    with pytest.raises(ValueError):
        geo.parse_bbox("1,2,3")
    box = geo.parse_bbox("10,46,12,47")
    p = lambda x, y: geo.in_bbox(F.lit(x), F.lit(y), box)
    assert one(spark, p(10.0, 46.0), p(12.0, 47.0), p(12.1, 46.5), geo.in_bbox(F.lit(1.0), F.lit(1.0), geo.parse_bbox("a,1,2,3")), geo.in_bbox(F.lit(1), F.lit(1), None)) == [True, True, False, False, True]


def test_rings(spark):
    assert one(spark, geo.ring(F.lit("(46.1,11.2), (46.3,11.4), (46.1,11.2)")))[0] == [[11.2, 46.1], [11.4, 46.3], [11.2, 46.1]]
    concave = [(0, 0), (4, 0), (4, 4), (2, 1), (0, 4), (0, 0)]
    rows = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.5, 2.0), (5.0, 1.0), (0.5, 2.5)], "x double, y double")
    assert sorted((r.x, r.y) for r in geo.inside(rows, "x", "y", concave).collect()) == [(0.5, 2.5), (1.0, 1.0), (3.5, 2.0)]


def test_vicinity(spark):
    a = spark.createDataFrame([(1, 46.5, 11.3), (2, 46.6, 11.3)], "id int, lat double, lon double")
    b = spark.createDataFrame([(7, 46.5003, 11.3003), (8, 46.51, 11.3)], "id int, lat double, lon double")
    assert [(r["id"], r["other_id"]) for r in geo.within(a, b, 50).collect()] == [(1, 7)]
