"""Log calls -> lines, request and response lines, delivery entries, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import wire
from ..functions.headers import headers_json, redacted_headers
from ..functions.jsontext import ENTRY, entry, joined_objects, number, overlay_text, present, quoted, record_text
from .recover import _PARSED, envelope_columns, wrapped_variant


def json_value(df: DataFrame, name: str) -> Column:
    """A plain column as JSON text, by its type."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return quoted(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return number(name)
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return F.col(name).cast("string")
    return F.to_json(F.col(name))


def _base_fields(df: DataFrame) -> list[tuple[str, Column]]:
    """The fields every line has, then the context fields that are set."""
    fields = [("level", quoted("level")), ("message", quoted("message"))]
    if "partner_id" in df.columns:
        fields.append(("partnerId", quoted("partner_id")))
    return fields + [(field, json_value(df, source)) for source, field in wire.CONTEXT_FIELDS if source in df.columns]


def drop_reserved_keys(data: Column) -> Column:
    """Top-level data fields without those under the envelope's prefix."""
    return F.filter(data, lambda e: ~e["key"].startswith(wire.ENVELOPE_PREFIX))


def _data(df: DataFrame) -> Column:
    return F.coalesce(F.col("data"), F.array().cast(ENTRY)) if "data" in df.columns else F.array().cast(ENTRY)


def compose_lines(calls: DataFrame, line: str = "line") -> DataFrame:
    """Adds the line of each call.

    Reads ``partner_ref, ts_ns, level, message``, the context columns that exist, and
    ``data`` (ordered fields). The envelope and the fields are written separately and
    joined as text, so nothing in the data can come before the marker."""

    def extra(key: str, source: str) -> list[tuple[str, Column]]:
        return [(key, quoted(F.nullif(F.col(source), F.lit(""))))] if source in calls.columns else []

    envelope = record_text(
        [
            (wire.MARKER_KEY, F.lit(f'"{wire.LINE_VERSION}"')),
            (wire.PARTNER_REF_KEY, quoted("partner_ref")),
            (wire.TIMESTAMP_KEY, quoted("ts_ns")),
            (wire.LEVEL_KEY, quoted("level")),
            *extra(wire.DIRECTION_KEY, "direction"),
            *extra(wire.UPSTREAM_INTEGRATION_KEY, "upstream_integration"),
            *extra(wire.UPSTREAM_BASE_URL_KEY, "upstream_base_url"),
        ]
    )
    fields = overlay_text(_base_fields(calls), F.col("_data"))
    rows = calls.withColumn("_data", drop_reserved_keys(_data(calls)))  # a column, or it would be filtered for each field
    return rows.withColumn(line, joined_objects(envelope, fields)).drop("_data")


def compose_entries(calls: DataFrame, line: str = "line") -> DataFrame:
    """The direct-delivery form: the line is the fields alone (no reserved keys to drop),
    with ``labels`` and ``root`` as they were at the time of the call."""
    return delivery_labels(calls).withColumn(line, overlay_text(_base_fields(calls), _data(calls)))


def delivery_labels(calls: DataFrame) -> DataFrame:
    """Adds ``labels{level, partnerId, direction}`` and
    ``root{upstream_integration, upstream_base_url}``."""
    have = lambda name: F.col(name) if name in calls.columns else F.lit(None).cast("string")
    return calls.withColumn(
        "labels",
        F.struct(F.col("level").alias("level"), have("partner_id").alias("partnerId"), have("direction").alias("direction")),
    ).withColumn(
        "root",
        F.struct(
            have("upstream_integration").alias("upstream_integration"),
            have("upstream_base_url").alias("upstream_base_url"),
        ),
    )


def validate_calls(calls: DataFrame) -> DataFrame:
    """Adds ``drop_reason`` to calls that cannot be logged; null for the others.

    Reads ``app_key, ts_ns`` (null when the time was no time) and, on request and
    response rows (``kind``), the fields such a row must have, which are described before
    the key is looked at. The text '0' counts as an empty key."""
    unusable = F.coalesce("app_key", F.lit("")).isin("", "0")
    has = calls.columns
    reason = F.when(F.lit(False), F.lit(None).cast("string"))
    if "kind" in has:
        lacks = lambda names: F.coalesce(
            *[F.when(F.col(n).isNull() if n in has else F.lit(True), n) for n in names]
        )
        request = lacks(["method", "path"])
        response = lacks(["status_code", "duration", "correlation_id"])
        reason = reason.when(
            (F.col("kind") == "request") & request.isNotNull(),
            F.concat(F.lit("Failed to send log: request could not be described: "), request),
        ).when(
            (F.col("kind") == "response") & response.isNotNull(),
            F.concat(F.lit("Failed to send log: response could not be described: "), response),
        )
    reason = reason.when(unusable, "API key is required for logging")
    reason = reason.when(F.col("ts_ns").isNull(), "timestamp is not epoch milliseconds")
    if "data_json" in has:
        broken = F.col("data_json").isNotNull() & F.try_parse_json("data_json").isNull()
        reason = reason.when(broken, "log entry could not be serialised")
    return calls.withColumn("drop_reason", reason)


def request_lines(requests: DataFrame) -> DataFrame:
    """Call rows for requests: message, level and data. Reads ``method, path, headers,
    correlation_id, app_key`` and ``body`` (JSON text; null = not given)."""
    headers = headers_json(redacted_headers(requests, "headers", "app_key"))
    data = present(
        entry("method", quoted("method")),
        entry("path", quoted("path")),
        entry("headers", headers),
        entry("correlation_id", quoted("correlation_id")),
        entry("body", F.col("body")),
    )
    return requests.withColumns({"level": F.lit("info"), "message": F.lit(wire.REQUEST_MESSAGE), "data": data})


def response_lines(responses: DataFrame, *, push: bool = False) -> DataFrame:
    """Call rows for responses. Reads ``status_code, duration, correlation_id, headers,
    body`` and, when present, ``trail_json, upstream_dropped``.

    A line leaves absent headers and body out and keeps an explicit null body (the JSON
    text ``null``); ``push`` always writes both."""
    rows = responses
    headers = headers_json(redacted_headers(rows, "headers", None if push else "app_key"))
    body = F.col("body")
    status = entry("status_code", F.col("status_code").cast("string"))
    ends = [entry("duration_ms", json_value(rows, "duration")), entry("correlation_id", quoted("correlation_id"))]
    if push:
        null = F.lit("null")
        parts = [status, entry("headers", F.coalesce(headers, null)), entry("body", F.coalesce(body, null)), *ends]
    else:
        parts = [status, entry("headers", headers), entry("body", body), *ends]
    if "trail_json" in rows.columns:
        dropped = F.coalesce(F.col("upstream_dropped"), F.lit(0))
        parts += [
            entry("upstream", F.col("trail_json")),
            entry("_upstreamTruncated", F.when(dropped > 0, "true")),
            entry("_upstreamDropped", F.when(dropped > 0, dropped)),
        ]
    return rows.withColumns({"level": F.lit("info"), "message": F.lit(wire.RESPONSE_MESSAGE), "data": present(*parts)})


# field name -> (column, type); read by name from the line's top level
_FIELDS = {
    "message": ("message", "string"),
    "method": ("method", "string"),
    "path": ("path", "string"),
    "status_code": ("status_code", "int"),
    "duration_ms": ("duration_ms", "double"),
    "request_id": ("request_id", "string"),
    "correlation_id": ("correlation_id", "string"),
    "headers": ("headers", "variant"),
    "body": ("body", "variant"),
    "upstream": ("upstream", "variant"),
    "_upstreamDropped": ("upstream_dropped", "int"),
}


def parse_lines(df: DataFrame, line: str = "line", attributes: str | None = None) -> DataFrame:
    """Envelope and documented fields of each line as columns; what a query does not
    select is never extracted. ``attributes`` names a map column whose
    ``<prefix>.data.<name>`` entries (the wire's prefix) count as fields."""
    parsed = df.withColumn(_PARSED, wrapped_variant(line))
    rows = envelope_columns(parsed, line)

    def field(name: str, kind: str) -> Column:
        value = F.try_variant_get(F.col(_PARSED), f'$.w["{name}"]', kind)
        if attributes is None:
            return value
        key = wire.ENVELOPE_PREFIX.rstrip("_") + ".data." + name
        given = F.try_element_at(F.col(attributes), F.lit(key))
        folded = F.coalesce(F.try_parse_json(given), F.try_parse_json(quoted(given))) if kind == "variant" else given
        return F.coalesce(value, folded if kind == "variant" else folded.try_cast(kind))

    return rows.withColumns(
        {
            **{column: field(name, kind) for name, (column, kind) in _FIELDS.items()},
            "direction": F.coalesce("direction", F.lit("inbound")),
        }
    ).drop(_PARSED)


def entity_fields(exchanges: DataFrame, keys: list[str], sides: dict[str, str]) -> DataFrame:
    """Body fields in long form: ``keys, side, field, value``. ``sides`` maps a side's
    name to its body column (VARIANT); only JSON objects contribute."""
    out = None
    for side, body in sides.items():
        objects = exchanges.filter(F.schema_of_variant(F.col(body)).startswith("OBJECT"))
        rows = objects.select(*keys, F.lit(side).alias("side"), F.col(body).alias("_b")).lateralJoin(
            exchanges.sparkSession.tvf.variant_explode(F.col("_b").outer())
        )
        rows = rows.select(*keys, "side", F.col("key").alias("field"), F.to_json("value").alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out
