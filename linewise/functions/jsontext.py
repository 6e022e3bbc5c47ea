"""JSON as text: written in a given order, and checked as a whole."""

from __future__ import annotations

import json
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..wire import LINE_START
from . import bind, col

ENTRY = "array<struct<key:string,value:string>>"
Fields = list[tuple[str, Column]]  # name -> JSON text
_TO_END = (1 << 31) - 1


def quoted(value: Column | str) -> Column:
    """A string as a JSON string literal; null stays null. Text with nothing to escape,
    nearly all of it, is only put in quotes."""
    text = col(value)
    escaped = F.btrim(F.to_json(F.array(text)), F.lit("[]"))
    return F.when(text.rlike(r'["\\\x00-\x1F]'), escaped).otherwise(F.concat(F.lit('"'), text, F.lit('"')))


def number(value: Column | str) -> Column:
    """A double as the sender writes JSON numbers: whole values without a fraction, plain from
    0.0001 up to 17 digits before the point, else as ``1.0e-5`` or ``1.25e+21``."""
    v = col(value)

    def shown(text: Column) -> Column:
        part = lambda n: F.regexp_extract(text, r"^-?(\d)\.(\d+)E(-?\d+)$", n)
        power = part(3).cast("int")
        digits, at = F.concat(part(1), F.when(part(2) == "0", "").otherwise(part(2))), power + 1
        zeros = lambda n: F.repeat(F.lit("0"), F.greatest(n, F.lit(0)))
        plain = (
            F.when(at <= 0, F.concat(F.lit("0."), zeros(-at), digits))
            .when(F.length(digits) <= at, F.concat(digits, zeros(at - F.length(digits))))
            .otherwise(F.concat(F.left(digits, at), F.lit("."), F.substring(digits, at + 1, F.length(digits))))
        )
        power_text = F.concat(F.when(power > 0, "+").otherwise(""), power.cast("string"))
        wide = F.concat(part(1), F.lit("."), part(2), F.lit("e"), power_text)
        sign = F.when(F.startswith(text, F.lit("-")), "-").otherwise("")
        return F.when(F.contains(text, F.lit("E")), F.concat(sign, F.when(at.between(-3, 17), plain).otherwise(wide))).otherwise(text)


    def rounded(places: int) -> Column:
        text = F.format_string(f"%.{places}E", v)
        part = lambda n: F.regexp_extract(text, r"^(-?\d)\.(\d+?)0*E([+-]\d+)$", n)
        shorter = F.concat(part(1), F.lit("."), part(2), F.lit("E"), part(3).cast("int").cast("string"))
        return F.when(text.try_cast("double") == v, shorter)

    # the JVM's text of a double may have digits that it does not take to read it back
    long = F.length(F.regexp_replace(v.cast("string"), "E.*|[^0-9]", "")) >= 16
    text = F.coalesce(F.when(long, F.coalesce(rounded(14), rounded(15))), v.cast("string"))
    small = (v == F.floor(v)) & (F.abs(v) < 1e15)
    return F.when(small, v.cast("bigint").cast("string")).otherwise(bind(text, shown))


def entry(key: str, json_value: Column) -> Column:
    """One ordered field; its value is JSON text, null when the field is absent."""
    return F.struct(F.lit(key).alias("key"), json_value.cast("string").alias("value"))


def present(*entries: Column) -> Column:
    """The fields that have a value, in order."""
    return F.filter(F.array(*entries), lambda e: e["value"].isNotNull())


def entries_of(json: Column | str) -> Column:
    """A JSON object's top-level fields in order, each value as JSON text."""
    fields = F.map_entries(F.from_json(col(json), "map<string,variant>"))
    return F.transform(
        fields,
        lambda e: F.struct(e["key"].alias("key"), F.coalesce(F.to_json(e["value"]), F.lit("null")).alias("value")),
    )


def _rendered(entries: Column) -> Column:
    return F.transform(entries, lambda e: F.concat(quoted(e["key"]), F.lit(":"), e["value"]))


def _pairs(fields: Fields) -> list[Column]:
    # a null value makes its text null, which concat_ws leaves out
    return [F.concat(F.lit(json.dumps(key) + ":"), value.cast("string")) for key, value in fields]


def object_text(entries: Column) -> Column:
    """Ordered fields as the text of one JSON object."""
    return F.concat(F.lit("{"), F.array_join(_rendered(entries), ","), F.lit("}"))


def record_text(fields: Fields) -> Column:
    """Fields known by name as the text of one JSON object, null ones left out."""
    return F.concat(F.lit("{"), F.concat_ws(",", *_pairs(fields)), F.lit("}"))


def overlay_text(fields: Fields, data: Column) -> Column:
    """``data`` written over known fields, as the text of one JSON object: a repeated key
    keeps its first place and takes the later value; a null field is not there."""
    given = F.map_from_entries(data)
    base = [(key, F.when(value.isNotNull(), F.coalesce(F.try_element_at(given, F.lit(key)), value.cast("string")))) for key, value in fields]

    def is_new(e: Column) -> Column:
        return ~reduce(or_, [(e["key"] == key) & value.isNotNull() for key, value in fields])

    rest = _rendered(F.filter(data, is_new))
    return F.concat(F.lit("{"), F.concat_ws(",", *_pairs(base), rest), F.lit("}"))


def joined_objects(first: Column, second: Column) -> Column:
    """Two non-empty JSON objects' texts as one object, the first one's keys first. The second,
    as a rule the long one, is named once: what holds a lambda is made anew for each use."""
    return F.concat(F.left(first, F.length(first) - 1), F.lit(","), F.substring(second, 2, _TO_END))


def wrapped_variant(value: Column | str) -> Column:
    """The text parsed as the member ``w`` of an object; null when it does not close
    where it should."""
    return F.try_parse_json(F.concat(F.lit('{"w":'), col(value), F.lit("}")))


def is_json_object(value: Column | str, wrapped: Column | None = None) -> Column:
    """True only when the WHOLE text is one JSON object. The parsers accept text after
    a complete value, so it is read twice: as the one element of an array and as a
    member of an object. ``wrapped`` is the second reading, when already at hand."""
    text = col(value)
    inside = wrapped_variant(text) if wrapped is None else wrapped
    one = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    return F.coalesce(text.rlike(r"^\s*\{") & one & inside.isNotNull(), F.lit(False))


def is_whole_line(value: Column | str, wrapped: Column | None = None) -> Column:
    """Starts with the marker, ends with the closing brace, parses as one object. The
    text is bound once: a filter on it may be pushed below the step that made it."""

    def check(text: Column) -> Column:
        return F.coalesce(
            F.when(text.startswith(LINE_START) & text.endswith("}"), is_json_object(text, wrapped)), F.lit(False)
        )

    return bind(col(value), check)


def ascii_length(json: Column | str) -> Column:
    """Bytes of the text with every non-ASCII UTF-16 unit written as a \\uXXXX escape. A column that
    is named is not bound."""

    def measured(text: Column) -> Column:
        units = F.octet_length(F.encode(text, "UTF-16BE")) / 2
        plain = F.octet_length(text) - F.octet_length(F.regexp_replace(text, r"[\x00-\x7F]++", ""))
        return F.when(F.octet_length(text) == F.char_length(text), F.octet_length(text)).otherwise((6 * units - 5 * plain).cast("int"))

    return measured(F.col(json)) if isinstance(json, str) else bind(json, measured)
