"""Metric points: read, checked as a batch, laid out in long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import wire

POINT = "struct<timestamp:string,value:double,period:string,series:string,metadata:variant>"
BATCH = f"struct<slug:string,timestamp:string,value:double,period:string,series:string,metadata:variant,points:array<{POINT}>>"


def read_metric_points(df: DataFrame, body: str = "body") -> DataFrame:
    """JSON bodies as (slug, points); the single-point form becomes one point."""
    parsed = df.withColumn("_b", F.from_json(body, BATCH))
    single = F.array(F.struct(*[F.col(f"_b.{n}").alias(n) for n in ("timestamp", "value", "period", "series", "metadata")]))
    points = F.coalesce(F.col("_b.points"), F.when(F.col("_b.timestamp").isNotNull(), single))
    return parsed.select(*[c for c in df.columns if c != body], F.col("_b.slug").alias("slug"), points.alias("points"))


def _trim(value: Column) -> Column:
    # the six ASCII characters the sender's trim removes
    return F.regexp_replace(value, r"^[ \t\n\r\x00\x0B]++|[ \t\n\r\x00\x0B]++$", "")


def _empty(value: Column) -> Column:
    return F.coalesce(value, F.lit("")).isin("", "0")


def metric_reason(app_key: Column | str, slug: Column | str, points: Column | str) -> Column:
    """Why a batch is refused, the first test it fails; null for a good one."""
    key, name, batch = F.col(app_key), F.col(slug), F.col(points)
    series = F.transform(F.filter(batch, lambda p: p["series"].isNotNull()), lambda p: _trim(p["series"]))
    too_long = F.transform(series, lambda s: F.octet_length(s) > wire.METRIC_MAX_SERIES_BYTES)
    # points are judged in order, so the earlier of a blank and a long one decides
    blank_at = F.array_position(F.transform(series, _empty), True)
    long_at = F.array_position(too_long, True)
    return (
        F.when(_empty(key), "API key is required for metrics")
        .when(_empty(name), "slug must be a non-empty string")
        .when(~F.lower(_trim(name)).rlike(r"^[a-z0-9-]+$"), "slug must contain only lowercase letters, numbers, and hyphens")
        .when(F.coalesce(F.size(batch), F.lit(0)) <= 0, "points must be a non-empty array")
        .when(F.size(batch) > wire.METRIC_MAX_POINTS, "Maximum 1000 points per request")
        .when(
            (blank_at > 0) & ((long_at == 0) | (blank_at < long_at)), "series must be a non-empty string when provided"
        )
        .when(long_at > 0, "series must be at most 50 characters")
    )


def validate_metrics(batches: DataFrame) -> DataFrame:
    """Adds ``reason``; one bad point refuses its whole batch."""
    return batches.withColumn("reason", metric_reason("app_key", "slug", "points"))


def explode_points(batches: DataFrame) -> DataFrame:
    """Accepted batches as one row per point; the slug stays as it was given."""
    kept = [c for c in batches.columns if c not in ("points", "reason")]
    good = batches.filter(F.col("reason").isNull()) if "reason" in batches.columns else batches
    return good.select(*kept, F.posexplode("points").alias("point_no", "_p")).select(*kept, "point_no", "_p.*")


def metric_series(points: DataFrame) -> DataFrame:
    """Points with their time, spread by (slug, series, time) range and sorted within, so
    a long series fills many partitions in order."""
    timed = points.withColumn("ts", F.try_to_timestamp("timestamp"))
    return timed.repartitionByRange("slug", "series", "ts").sortWithinPartitions("slug", "series", "ts")
