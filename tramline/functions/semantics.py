"""Scalar rules for loosely typed data: truthiness, fallbacks, first-match replacement and their like.

Open metadata is kept as VARIANT, so that an absent key, a JSON null, 0 and "" stay apart.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = r"[\s   -     　﻿]"


def truthy(c: Column, kind: str = "boolean") -> Column:
    """False for null, false, 0, NaN and ""; never null."""
    if kind == "boolean":
        return F.coalesce(c, F.lit(False))
    if kind == "string":
        return F.coalesce(c != "", F.lit(False))
    if kind == "number":
        return F.coalesce((c != 0) & ~F.isnan(c.cast("double")), F.lit(False))
    return c.isNotNull()


def or_null(c: Column, kind: str = "number") -> Column:
    """c, or null where it is falsy."""
    return F.when(truthy(c, kind), c)


def or_else(c: Column, other: Column, kind: str = "number") -> Column:
    """c, or the other where c is falsy."""
    return F.when(truthy(c, kind), c).otherwise(other)


def get(v: Column, path: str, kind: str) -> Column:
    """A field of a VARIANT as a type, or null if it is absent, null or of no such form."""
    return F.try_variant_get(v, f"$['{path}']" if "." not in path else "$." + path, kind)


def field(v: Column, name: str) -> Column:
    """A field of a VARIANT as VARIANT: SQL null if absent, a variant null if the JSON value is null."""
    return F.try_variant_get(v, f"$['{name}']", "variant")


def is_absent(v: Column) -> Column:
    return v.isNull()


def is_json_null(v: Column) -> Column:
    return v.isNotNull() & F.is_variant_null(v)


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def truthy_variant(v: Column) -> Column:
    """Truthiness of a VARIANT: objects and arrays are true, scalars by their value."""
    text = F.try_variant_get(v, "$", "string")
    number = F.try_variant_get(v, "$", "double")
    kind = _kind(v)
    nested = F.try_variant_get(v, "$", "struct<>").isNotNull() | F.try_variant_get(v, "$", "array<variant>").isNotNull()  # cheaper than a schema, which goes through all of it
    return F.coalesce(
        F.when(v.isNull() | F.is_variant_null(v), False)
        .when(nested, True)
        .when(kind == "STRING", text != "")
        .when(kind == "BOOLEAN", text == "true")
        .otherwise((number != 0) & ~F.isnan(number)),
        F.lit(False),
    )


def to_number(v: Column) -> Column:
    """The number that arithmetic makes of a VARIANT: null is 0, text is parsed; absent or unparsable gives null."""
    kind = _kind(v)
    text = trim_space(F.try_variant_get(v, "$", "string"))
    return (
        F.when(v.isNull(), F.lit(None).cast("double"))
        .when(F.is_variant_null(v), F.lit(0.0))
        .when(kind == "BOOLEAN", F.when(text == "true", 1.0).otherwise(0.0))
        .when((kind == "STRING") & (text == ""), F.lit(0.0))
        .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), F.lit(None).cast("double"))
        .otherwise(text.try_cast("double"))
    )


def loosely_equals(v: Column, number: float) -> Column:
    """Equality after conversion to a number; absent and JSON null equal nothing."""
    return F.coalesce(~(v.isNull() | F.is_variant_null(v)) & (to_number(v) == number), F.lit(False))


def strictly_equals(v: Column, number: float) -> Column:
    """Equality of a numeric VARIANT and a number; text and booleans equal no number."""
    return F.coalesce(~_kind(v).isin("STRING", "BOOLEAN") & (F.try_variant_get(v, "$", "double") == number), F.lit(False))


def replace_first(c: Column, old: str, new: str) -> Column:
    """Replaces the first occurrence of a piece of text."""
    at = F.instr(c, old)
    return F.when(at > 0, F.concat(F.substring(c, 1, at - 1), F.lit(new), F.substring(c, at + len(old), F.length(c)))).otherwise(c)


def trim_space(c: Column) -> Column:
    """Without any white space at both ends."""
    return F.regexp_replace(c, f"^{_SPACE}+|{_SPACE}+$", "")


def trimmed_or_empty(c: Column) -> Column:
    return F.coalesce(trim_space(c), F.lit(""))


def title_words(c: Column) -> Column:
    """Lower case, but for the first letter of each word between single spaces."""
    return F.array_join(F.transform(F.split(F.lower(c), " "), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), " ")


def yes_no(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit(False)), "yes").otherwise("no")


def key_text(v: Column) -> Column:
    """A VARIANT as the text of a key: absent is "undefined", JSON null is "null"."""
    return F.when(v.isNull(), "undefined").when(F.is_variant_null(v), "null").otherwise(F.try_variant_get(v, "$", "string"))


def first_seen_keys(keys: Column) -> Column:
    """Distinct keys of an array in the order of an object's keys: whole numbers first, ascending, then as first seen."""
    distinct = F.array_distinct(keys)
    whole = lambda k: k.rlike("^(0|[1-9][0-9]{0,9})$") & (k.cast("bigint") < 4294967295)
    numbers = F.transform(F.array_sort(F.transform(F.filter(distinct, whole), lambda k: k.cast("bigint"))), lambda n: n.cast("string"))
    return F.concat(numbers, F.filter(distinct, lambda k: ~whole(k)))


def decimal_comma(c: Column) -> Column:
    """The number at the start of a text, with a decimal comma or point; null if there is none."""
    return F.regexp_extract(replace_first(trim_space(c), ",", "."), r"^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?)", 0).try_cast("double")


def opening_hours(start: Column, end: Column, lunch_start: Column, lunch_end: Column) -> Column:
    """Daily hours as text, in two parts if both ends of a break are given; null unless start and end are."""
    one = F.concat(F.lit("Mo-Su "), start, F.lit("-"), end)
    two = F.concat(F.lit("Mo-Su "), start, F.lit("-"), lunch_start, F.lit(", Mo-Su "), lunch_end, F.lit("-"), end)
    both = truthy(lunch_start, "string") & truthy(lunch_end, "string")
    return F.when(truthy(start, "string") & truthy(end, "string"), F.when(both, two).otherwise(one))


def slug(prefix: str, c: Column) -> Column:
    """A category: prefix, and the text with spaces as underscores."""
    return F.concat(F.lit(prefix), F.replace(c, F.lit(" "), F.lit("_")))


def prefixed_lower(prefix: str, items: Column) -> Column:
    return F.transform(items, lambda m: F.concat(F.lit(prefix), F.lower(m)))


def whole_record(*columns: str) -> Column:
    """Columns as JSON text that keeps nulls."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def char_hex(c: Column) -> Column:
    """Code units of an ASCII text as lower-case hexadecimal."""
    return F.lower(F.hex(F.encode(c, "UTF-8")))


def version_in(c: Column, name: str) -> Column:
    """The version behind `name-` and before an extension, as the last on a line; empty if there is none."""
    return F.regexp_extract(c, rf".*{name}-([0-9][0-9A-Za-z._]*?)\.[a-z]+\b", 1)


def is_older(modified: Column, now: Column, seconds: int) -> Column:
    """Whether epoch seconds lie more than so many seconds back."""
    return (now - modified) > seconds


def calendar_bounds(start: Column, end: Column, today: Column, zone: str) -> tuple[Column, Column]:
    """First and last day as text: of the epoch seconds given, or this year's first and next year's last (0 is not given).

    An end at midnight counts as the day before it.
    """
    day = lambda s: F.date_format(F.from_utc_timestamp(F.timestamp_seconds(s), zone), "yyyy-MM-dd")
    return (
        F.when(truthy(start, "number"), day(start)).otherwise(F.concat(F.year(today).cast("string"), F.lit("-01-01"))),
        F.when(truthy(end, "number"), day(end - 1)).otherwise(F.concat((F.year(today) + 1).cast("string"), F.lit("-12-31"))),
    )


def day_in_range(day: Column, first: Column, last: Column) -> Column:
    """Inclusive, as text; a blank day is in no range."""
    return F.coalesce((trim_space(day) != "") & (day >= first) & (day <= last), F.lit(False))


def rounded(c: Column) -> Column:
    """The nearest whole number; halves go up."""
    return F.floor(c + 0.5).cast("double")


def parsed_property(c: Column, schema: str) -> Column:
    """A property that holds JSON text, as an array; null where there is no text."""
    return F.when(truthy(c, "string"), F.from_json(c, schema))


def decimal_point(c: Column) -> Column:
    """The number at the start of a text, with a decimal point."""
    return F.regexp_extract(trim_space(c), r"^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?)", 0).try_cast("double")
