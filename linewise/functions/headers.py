"""HTTP header maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..wire import REDACTED, SENSITIVE_HEADERS
from . import col


def _by_name(name: Column) -> Column:
    return F.lower(name).isin(*SENSITIVE_HEADERS)


def redact_headers(headers: Column | str, app_key: Column | str | None = None) -> Column:
    """Header values with credentials replaced: by name always, and with ``app_key``
    also any value exactly equal to it."""
    if app_key is None:
        return F.transform_values(col(headers), lambda k, v: F.when(_by_name(k), REDACTED).otherwise(v))
    key = col(app_key)
    return F.transform_values(
        col(headers), lambda k, v: F.when(_by_name(k) | F.coalesce(v == key, F.lit(False)), REDACTED).otherwise(v)
    )


def redact_header_lists(headers: Column | str, app_key: Column | str | None = None) -> Column:
    """The same for headers holding a list of values each; a sensitive name keeps one
    marker, another name is checked value by value."""
    key = F.lit(None).cast("string") if app_key is None else col(app_key)
    return F.transform_values(
        col(headers),
        lambda k, vs: F.when(_by_name(k), F.array(F.lit(REDACTED))).otherwise(
            F.transform(vs, lambda v: F.when(v == key, REDACTED).otherwise(v))
        ),
    )


def redacted_headers(df: DataFrame, name: str, app_key: str | None = None) -> Column:
    """The header column ``name`` of ``df`` redacted, whether it holds a value or a list for each name."""
    kind = df.schema[name].dataType
    lists = isinstance(kind, T.MapType) and isinstance(kind.valueType, T.ArrayType)
    return (redact_header_lists if lists else redact_headers)(name, app_key)


def headers_json(headers: Column) -> Column:
    """A header map as a JSON object, an empty one as ``{}``."""
    return F.to_json(headers)


def correlation_id(headers: Column | str, row_key: Column | str) -> Column:
    """The given correlation id, else one derived from the row's own key, so that a
    retried task writes the same id."""
    digest = F.sha2(F.encode(col(row_key).cast("string"), "UTF-8"), 256)
    part = lambda start, size: F.substring(digest, start, size)
    derived = F.concat_ws(
        "-",
        part(1, 8),
        part(9, 4),
        F.concat(F.lit("4"), part(14, 3)),
        F.concat(F.translate(part(17, 1), "0123456789abcdef", "89ab89ab89ab89ab"), part(18, 3)),
        part(21, 12),
    )
    return F.coalesce(F.try_element_at(col(headers), F.lit("x-correlation-id")), derived)
