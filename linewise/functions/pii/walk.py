"""Redaction of nested columns: structs, maps, arrays and JSON documents.

A sensitive name gives its value a marker, whatever the value's type was; names are
redacted themselves; numbers, booleans and nulls pass.
"""

from __future__ import annotations

import json
from itertools import count

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...session import ship_package
from .. import bind, col
from .keys import DROPPED_NAME, is_sensitive_key, key_marker, name_is_sensitive, name_marker
from .leaf import redact_name, redact_string
from .options import DEFAULT, Options
from .rules import FAILED_MARKER
from .text import native_chain, needs_python, redact_text


def distinct_names(names: list[str]) -> list[str]:
    """The names in order, each made its own: one seen before gets the first free ``#2``, ``#3``."""
    given: dict[str, None] = {}
    for name in names:
        numbered = (f"{name}#{n}" for n in count(2))
        given[name if name not in given else next(c for c in numbered if c not in given)] = None
    return list(given)


class _Number(str):
    """A JSON number, as written."""


class _Object(list):
    """A JSON object's (name, value) pairs, repeated names included."""


def _refuse(word: str):
    raise ValueError(f"{word} is not JSON")


_decoder = json.JSONDecoder(parse_float=_Number, parse_int=_Number, parse_constant=_refuse, object_pairs_hook=_Object)


def _written(value, options: Options) -> str:
    """One parsed JSON value redacted, as JSON text."""
    if isinstance(value, _Object):
        shown = []
        for name, inner in value:
            hidden = name_is_sensitive(name)
            new = redact_name(name, options)
            if new != DROPPED_NAME and (options.preserve_structure or not hidden):
                shown.append((new, _quoted(name_marker(name)) if hidden else _written(inner, options)))
        names = distinct_names([name for name, _ in shown])
        return "{" + ",".join(f"{_quoted(name)}:{text}" for name, (_, text) in zip(names, shown)) + "}"
    if isinstance(value, list):
        return "[" + ",".join(_written(v, options) for v in value) + "]"
    if isinstance(value, _Number):
        return value
    return _quoted(redact_string(value, options)) if isinstance(value, str) else json.dumps(value)


def _quoted(text: str) -> str:
    return json.dumps(text, ensure_ascii=False)


def redact_document(text: str, options: Options) -> str:
    try:
        return _written(_decoder.decode(text), options)
    except Exception:  # noqa: BLE001 - never hand back what could not be read
        return _quoted(FAILED_MARKER)


def _json_udf(options: Options):
    ship_package()

    @F.pandas_udf("string")
    def redact_documents(documents: pd.Series) -> pd.Series:
        return pd.Series([None if t is None or t is pd.NA or t != t else redact_document(t, options) for t in documents], dtype=object)

    return redact_documents


def redact_json(value: Column | str, options: Options = DEFAULT) -> Column:
    """A column of JSON documents redacted, numbers as written, repeated names numbered; one
    that does not parse, or holds NaN or Infinity, becomes a marker."""
    return _json_udf(options)(col(value))


def _shown_fields(kind: T.StructType, options: Options) -> list[tuple[str, str, T.DataType, str | None]]:
    """(old name, new name, type, marker or None) of the fields that stay."""
    stay = []
    for field in kind.fields:
        marker = name_marker(field.name) if name_is_sensitive(field.name) else None
        new = redact_name(field.name, options)
        if new != DROPPED_NAME and (options.preserve_structure or marker is None):
            stay.append((field.name, new, field.dataType, marker))
    names = distinct_names([new for _, new, _, _ in stay])
    return [(old, name, inner, marker) for name, (old, _, inner, marker) in zip(names, stay)]


def _named(kind: T.DataType) -> bool:
    return isinstance(kind, T.MapType) and isinstance(kind.keyType, T.StringType)


def _json_text(value: Column, kind: T.DataType) -> Column:
    """A map's value beside markers: texts as they are, all else as JSON text."""
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(value, {"ignoreNullFields": "false"})
    return value.cast("string")


def _leaves(value: Column, kind: T.DataType, options: Options, names: bool) -> Column:
    """An array of the texts (or, with ``names``, the map names) that need Python."""
    none = F.array().cast("array<string>")
    if isinstance(kind, T.StringType):
        return none if names else F.when(needs_python(value, options), F.array(value)).otherwise(none)
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.flatten(F.transform(value, lambda v: _leaves(v, kind.elementType, options, names))), none)
    if isinstance(kind, T.StructType):
        parts = [_leaves(value.getField(f.name), f.dataType, options, names) for f in kind.fields if not name_is_sensitive(f.name)]
        return F.concat(none, *parts)
    if isinstance(kind, T.MapType):
        inner = F.coalesce(F.flatten(F.transform(F.map_values(value), lambda v: _leaves(v, kind.valueType, options, names))), none)
        if names and _named(kind):
            own = F.filter(F.map_keys(value), lambda k: needs_python(k, options, names=True))
            return F.concat(F.coalesce(own, none), inner)
        return inner
    return none


def _has_leaves(kind: T.DataType, names: bool) -> bool:
    """Whether values of this type hold texts, or map names, at all."""
    if isinstance(kind, T.StructType):
        return any(_has_leaves(f.dataType, names) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_leaves(kind.elementType, names)
    if isinstance(kind, T.MapType):
        return (names and _named(kind)) or _has_leaves(kind.valueType, names)
    return isinstance(kind, T.StringType) and not names


def _array_udf(options: Options, names: bool):
    ship_package()

    @F.pandas_udf("array<string>")
    def redact_array(lists: pd.Series) -> pd.Series:
        return pd.Series([None if texts is None else [redact_string(t, options, names) for t in texts] for texts in lists], dtype=object)

    return redact_array


def _answers(value: Column, kind: T.DataType, options: Options, names: bool) -> Column:
    """A map from each text that needs Python to its redaction, null where there is none."""
    if not _has_leaves(kind, names):
        return F.lit(None).cast("map<string,string>")
    asked = F.array_distinct(_leaves(value, kind, options, names))
    asked = F.when(F.size(asked) > 0, asked)
    return F.map_from_arrays(asked, _array_udf(options, names)(asked))


def _numbered(names: Column) -> Column:
    """``distinct_names`` of an array of names."""

    def step(given: Column, name: Column) -> Column:
        numbered = F.transform(F.sequence(F.lit(2), F.size(given) + 2), lambda n: F.concat(name, F.lit("#"), n.cast("string")))
        free = F.filter(numbered, lambda c: ~F.array_contains(given, c))[0]
        return F.concat(given, F.array(F.when(F.array_contains(given, name), free).otherwise(name)))

    clash = F.size(F.array_distinct(names)) < F.size(names)
    return F.when(clash, F.aggregate(names, F.array().cast("array<string>"), step)).otherwise(names)


def _redacted(value: Column, kind: T.DataType, options: Options, texts: Column, names: Column) -> Column:
    """The value rebuilt: every text by its answer or the JVM chain, nothing else touched."""
    if isinstance(kind, T.StringType):
        return F.when(value.isNotNull(), F.coalesce(texts[value], native_chain(value, options, share=False)))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: _redacted(v, kind.elementType, options, texts, names))
    if isinstance(kind, T.StructType):
        parts = [
            (F.lit(marker) if marker else _redacted(value.getField(old), inner, options, texts, names)).alias(new)
            for old, new, inner, marker in _shown_fields(kind, options)
        ]
        return F.when(value.isNotNull(), F.struct(*parts)) if parts else F.lit(None).cast("struct<>")
    if _named(kind):
        return _redacted_map(value, kind, options, texts, names)
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, v: _redacted(v, kind.valueType, options, texts, names))
    return value


def _redacted_map(value: Column, kind: T.MapType, options: Options, texts: Column, names: Column) -> Column:
    def one(entry: Column) -> Column:
        name = F.coalesce(names[entry["key"]], native_chain(entry["key"], options, names=True, share=False))
        inner = _redacted(entry["value"], kind.valueType, options, texts, names)
        if options.preserve_structure:
            text = inner if isinstance(kind.valueType, T.StringType) else _json_text(inner, kind.valueType)
            inner = F.when(is_sensitive_key(entry["key"]), key_marker(entry["key"])).otherwise(text)
        return F.struct(name.alias("key"), inner.alias("value"))

    entries = F.map_entries(value)
    if not options.preserve_structure:
        entries = F.filter(entries, lambda e: ~is_sensitive_key(e["key"]))
    shown = F.filter(F.transform(entries, one), lambda e: e["key"] != DROPPED_NAME)
    return bind(shown, lambda e: F.map_from_arrays(_numbered(e["key"]), e["value"]))


def redact_column(value: Column | str, kind: T.DataType, options: Options = DEFAULT) -> Column:
    """A column of any type redacted. Only texts cross to Python, those that need it, in one
    array a row; every other value stays in the JVM as it is.

    A sensitive name hides its value whatever the type: a struct field becomes a string, and a
    map by names whose values are not strings becomes a map of strings, its other values JSON
    text (unless structure is not kept: then sensitive entries go and types stay)."""
    target = col(value)
    if isinstance(kind, T.StringType):
        return redact_text(target, options)
    if not isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return target
    fixes = F.struct(_answers(target, kind, options, False).alias("texts"), _answers(target, kind, options, True).alias("names"))
    return bind(fixes, lambda fix: _redacted(target, kind, options, fix["texts"], fix["names"]))


def redact(df: DataFrame, columns: list[str] | None = None, options: Options = DEFAULT, json_columns: tuple[str, ...] = ()) -> DataFrame:
    """The DataFrame with the given columns (all, by default) redacted. A column with a
    sensitive name becomes its marker, or goes when structure is not kept."""
    chosen = set(columns if columns is not None else df.columns)
    out = []
    for field in df.schema.fields:
        name = field.name
        if name not in chosen:
            out.append(F.col(f"`{name}`"))
        elif name_is_sensitive(name):
            if options.preserve_structure:
                out.append(F.lit(name_marker(name)).alias(name))
        elif name in json_columns:
            out.append(redact_json(F.col(f"`{name}`"), options).alias(name))
        else:
            out.append(redact_column(F.col(f"`{name}`"), field.dataType, options).alias(name))
    return df.select(*out)
