"""From container or file text to whole lines."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import wire
from ..functions.jsontext import is_whole_line, wrapped_variant
from ..functions.timestamps import ns_to_seconds
from ..session import ship_package
from .greedy import greedy_runs
from .ordered import CHUNK, DEFAULT_CHUNK_ROWS, by_position, join_carry, local_window

def read_cri(df: DataFrame, text: str = "text") -> DataFrame:
    """``<time> <stdout|stderr> <P|F> <log>`` rows taken apart; a row of another shape
    goes. One split at the first three spaces; the log keeps all of its own. Filters, also
    later ones on the stream, look at a row's head, so that none splits it again."""
    rows = df.filter(F.col(text).rlike(r"\A\S+ (?:stdout|stderr) [PF] "))
    parts = rows.withColumn("_p", F.split(F.col(text), " ", 4))
    part = lambda i: F.get("_p", F.lit(i))
    return parts.select(
        *[c for c in df.columns if c != text],
        part(0).alias("time"),
        F.when(F.col(text).rlike(r"\A\S+ stdout "), "stdout").otherwise("stderr").alias("stream"),
        part(2).alias("tag"),
        part(3).alias("log"),
        (part(2) == "F").alias("is_last"),
    )


def read_docker_json(df: DataFrame, text: str = "text") -> DataFrame:
    """Docker's JSON wrapper removed; a row that is not such an object goes. The last
    part of a line is the one that ends with a newline."""
    parsed = df.withColumn("_o", F.from_json(F.col(text), "log string, stream string, time string"))
    good = parsed.filter(F.col("_o.log").isNotNull() & F.col("_o.stream").isNotNull())
    return good.select(
        *[c for c in df.columns if c != text], "_o.time", "_o.stream", "_o.log", F.col("_o.log").endswith("\n").alias("is_last")
    )


def drop_stderr(df: DataFrame) -> DataFrame:
    """Only stdout rows; before any rejoining, so that streams never mix."""
    return df.filter(F.col("stream") == "stdout")


def _segments(df: DataFrame, keys: list[str], order: Sequence[str], chunk: Column | None) -> DataFrame:
    """Adds ``_start`` (rows of the group before this line's first part), ``_place`` (parts of
    the line before this one) and ``_before`` (their bytes), with a line ending only at its last part."""
    rows = df.withColumn(CHUNK, chunk if chunk is not None else by_position(order[0], DEFAULT_CHUNK_ROWS))
    window = local_window(keys, order)
    rows = rows.withColumn("_size", F.octet_length("log").cast("bigint")).withColumn("_n", F.row_number().over(window).cast("bigint"))
    rows = rows.withColumn("_bytes", F.sum("_size").over(window.rowsBetween(W.unboundedPreceding, 0)))
    end, end_bytes = F.when(F.col("is_last"), F.col("_n")), F.when(F.col("is_last"), F.col("_bytes"))
    earlier_here = window.rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumns({"_end": F.max(end).over(earlier_here), "_end_bytes": F.max(end_bytes).over(earlier_here)})
    totals = rows.groupBy(*keys, CHUNK).agg(
        F.max("_n").alias("_rows"), F.max(end).alias("_last"), F.max("_bytes").alias("_sum"), F.max(end_bytes).alias("_last_bytes")
    )
    earlier = W.partitionBy(*keys).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.withColumns({"_offset": F.sum("_rows").over(earlier), "_offset_bytes": F.sum("_sum").over(earlier)})
    carried = {
        "_carried": F.last(F.coalesce("_offset", F.lit(0)) + F.col("_last"), ignorenulls=True).over(earlier),
        "_carried_bytes": F.last(F.coalesce("_offset_bytes", F.lit(0)) + F.col("_last_bytes"), ignorenulls=True).over(earlier),
    }
    carry = offsets.withColumns(carried).filter(F.col("_offset").isNotNull())
    joined = join_carry(rows, carry.select(*keys, CHUNK, "_offset", "_carried", "_offset_bytes", "_carried_bytes"), keys)
    offset, offset_bytes = F.coalesce("_offset", F.lit(0)), F.coalesce("_offset_bytes", F.lit(0))
    start = F.coalesce(offset + F.col("_end"), F.col("_carried"), F.lit(0)).cast("bigint")
    start_bytes = F.coalesce(offset_bytes + F.col("_end_bytes"), F.col("_carried_bytes"), F.lit(0))
    found = joined.withColumns({
        "_start": start, "_place": offset + F.col("_n") - 1 - start, "_before": offset_bytes + F.col("_bytes") - F.col("_size") - start_bytes,
    })
    return found.drop(CHUNK, "_n", "_bytes", "_end", "_end_bytes", "_offset", "_carried", "_offset_bytes", "_carried_bytes")


def part_groups(
    df: DataFrame,
    by: Sequence[str] = ("file", "stream"),
    order: Sequence[str] = ("pos",),
    chunk: Column | None = None,
    max_parts: int = wire.MAX_PARTS,
    max_bytes: int = wire.MAX_LINE_BYTES,
) -> DataFrame:
    """Adds ``line_start`` (rows of the group before this line's first part) and
    ``part_no`` (0 for a first part). A line that does not end is cut after the part that
    makes ``max_parts`` parts or ``max_bytes`` bytes, and the next part starts another line.

    The first cut of a line is seen from running sums. Where a line goes on beyond it, the
    further cuts are greedy runs over the places and sizes of the parts from there on; these
    rows alone are joined to them."""
    keys = list(by)
    rows = _segments(df, keys, order, chunk)
    beyond = (F.col("_place") >= max_parts) | (F.col("_before") >= max_bytes)
    within = rows.filter(~beyond).withColumns({"line_start": F.col("_start"), "part_no": F.col("_place").cast("int")})
    more = rows.filter(beyond)
    # mostly there are none, which adaptive execution sees from this exchange and then leaves the rest out
    slim = more.select(*keys, F.col("_start").alias("_line"), "_place", "_size").repartition(*keys, "_line")
    runs = greedy_runs(slim, [*keys, "_line"], "_place", "_size", max_parts, max_bytes, DEFAULT_CHUNK_ROWS, reaching=True)
    cut = more.join(runs.select(*keys, F.col("_line").alias("_start"), "_place", "run_start"), [*keys, "_start", "_place"]).withColumns(
        {"line_start": F.col("_start") + F.col("run_start"), "part_no": (F.col("_place") - F.col("run_start")).cast("int")}
    )
    out = [*df.columns, "line_start", "part_no"]
    return within.select(*out).unionByName(cut.select(*out))


def rejoin_parts(
    df: DataFrame,
    by: Sequence[str] = ("file", "stream"),
    order: Sequence[str] = ("pos",),
    chunk: Column | None = None,
    max_parts: int = wire.MAX_PARTS,
    max_bytes: int = wire.MAX_LINE_BYTES,
) -> DataFrame:
    """Split lines put together: ``by``, ``line_start``, ``line``, ``parts``; a line that does not
    end is cut as ``part_groups`` says.

    A line of one part passes straight through; only the parts of split lines are
    shuffled once more, to a key of their own, so a long file spreads out."""
    keys = list(by)
    parts = part_groups(df, by, order, chunk, max_parts, max_bytes)
    alone = (F.col("part_no") == 0) & F.col("is_last")
    single = parts.filter(alone).select(*keys, "line_start", F.col("log").alias("line"), F.lit(1).alias("parts"))
    joined = (
        parts.filter(~alone)
        .groupBy(*keys, "line_start")
        .agg(F.sort_array(F.collect_list(F.struct("part_no", "log"))).alias("_p"))
        .select(*keys, "line_start", F.array_join("_p.log", "").alias("line"), F.size("_p").alias("parts"))
    )
    return single.unionByName(joined).withColumn("line", F.regexp_replace("line", r"\n\z", ""))


def keep_whole_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """Only whole lines; anything that cannot be checked goes."""
    return df.filter(is_whole_line(line))


def supported_version(version: Column) -> Column:
    return version.rlike(r"^1\.")


def marker_version(df: DataFrame, line: str = "line") -> DataFrame:
    """Lines of a supported major version."""
    return df.filter(supported_version(F.get_json_object(line, f"$.{wire.MARKER_KEY}")))


def drop_overlong(df: DataFrame, max_bytes: int = wire.MAX_LINE_BYTES, line: str = "line") -> DataFrame:
    return df.filter(F.octet_length(line) <= max_bytes)


_skip = re.compile(r"[ \t\r\n]*+")
_value = json.JSONDecoder()


def without_field(text: str, name: str, instead: str) -> str:
    """A JSON object's text without the top-level field ``name``, and with the field text
    ``instead`` last; every other field stays byte for byte. A text that is no object stays."""
    try:
        at, kept = _skip.match(text).end() + 1, [instead]
        if text[at - 1] != "{":
            return text
        while text[(at := _skip.match(text, at).end())] != "}":
            start = at
            key, at = _value.raw_decode(text, at)
            at = _skip.match(text, _skip.match(text, at).end() + 1).end()  # over the colon
            _, at = _value.raw_decode(text, at)
            if key != name:
                kept.insert(-1, text[start:at])
            at = _skip.match(text, at).end()
            at += text[at] == ","
        return "{" + ",".join(kept) + "}"
    except (ValueError, IndexError):
        return text


def strip_long_bodies(df: DataFrame, max_bytes: int = wire.STORED_LINE_BYTES, line: str = "line") -> DataFrame:
    """A line longer than ``max_bytes`` keeps its fields, as written, but not its ``body``. Only
    such lines cross to Python."""
    ship_package(df.sparkSession)

    @F.pandas_udf("string")
    def stripped(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else without_field(t, "body", '"_bodyDropped":true') for t in texts], dtype=object)

    long = F.octet_length(line) > max_bytes
    return df.withColumn(line, F.when(long, stripped(F.when(long, F.col(line)))).otherwise(F.col(line)))


_PARSED = "_parsed"


def envelope_columns(df: DataFrame, line: str = "line") -> DataFrame:
    """The envelope of each line as columns. The version, reference, time and level
    count only when they are JSON strings; any other value is null."""
    rows = df if _PARSED in df.columns else df.withColumn(_PARSED, wrapped_variant(line))

    def text(key: str) -> Column:
        return F.try_variant_get(F.col(_PARSED), f"$.w.{key}", "string")

    def string_only(key: str) -> Column:
        value = F.try_variant_get(F.col(_PARSED), f"$.w.{key}", "variant")
        return F.when(F.schema_of_variant(value) == "STRING", text(key))

    return rows.select(
        *df.columns,
        string_only(wire.MARKER_KEY).alias("line_version"),
        string_only(wire.PARTNER_REF_KEY).alias("partner_ref"),
        string_only(wire.TIMESTAMP_KEY).alias("ts_ns"),
        string_only(wire.LEVEL_KEY).alias("level"),
        text(wire.DIRECTION_KEY).alias("direction"),
        text(wire.UPSTREAM_INTEGRATION_KEY).alias("upstream_integration"),
        text(wire.UPSTREAM_BASE_URL_KEY).alias("upstream_base_url"),
    )


def classify_lines(
    df: DataFrame,
    now_seconds: Column,
    max_age: int = wire.MAX_AGE_SECONDS,
    max_ahead: int = wire.MAX_AHEAD_SECONDS,
    line: str = "line",
) -> DataFrame:
    """Adds the envelope columns and ``reason``, the first test a line fails; null for
    a line that is stored. One narrow pass; accept and reject are filters on it."""
    parsed = df.withColumn(_PARSED, wrapped_variant(line))
    whole = parsed.withColumn("_whole", is_whole_line(line, F.col(_PARSED)))
    rows = envelope_columns(whole, line)
    marked = F.contains(F.col(line), F.lit(wire.MARKER_KEY))
    seconds = ns_to_seconds("ts_ns")

    def bad_attribution(value: str) -> Column:
        size = F.octet_length(value)
        return F.col(value).isNotNull() & ((size == 0) | (size > wire.MAX_ATTRIBUTION_BYTES))

    out_of_range = (seconds < now_seconds - max_age) | (seconds > now_seconds + max_ahead)
    reason = (
        F.when(~F.coalesce(marked, F.lit(False)), "no_marker")
        .when(~F.col("_whole"), "unparseable_line")
        .when(~F.coalesce(supported_version(F.col("line_version")), F.lit(False)), "unsupported_marker")
        .when(F.coalesce("partner_ref", F.lit("")) == "", "missing_partner_ref")
        .when(F.coalesce("level", F.lit("")) == "", "bad_level")
        .when(seconds.isNull(), "bad_timestamp")
        .when(out_of_range, "timestamp_out_of_range")
        .when(F.col("direction").isNotNull() & ~F.col("direction").isin(*wire.DIRECTIONS), "bad_direction")
        .when(bad_attribution("upstream_integration") | bad_attribution("upstream_base_url"), "bad_upstream_attribution")
    )
    return rows.withColumn("reason", reason).drop("_whole", _PARSED)


def dedupe_lines(df: DataFrame, keys: Sequence[str] = ("partner_ref", "line")) -> DataFrame:
    """Delivery is at least once: one row per line. The key that is shuffled is a digest
    of a long line, not the line."""
    columns = df.columns
    digest = F.sha2(F.to_json(F.struct(*[F.col(k) for k in keys])), 256)
    kept = df.withColumn("_d", digest).groupBy("_d").agg(*[F.first(c).alias(c) for c in columns])
    return kept.select(*columns)
