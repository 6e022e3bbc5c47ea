"""Lines over time: checked, deduplicated and paired."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import wire
from ..operators.recover import classify_lines, drop_overlong


def stream_lines(lines: DataFrame, now_seconds: Column | None = None) -> DataFrame:
    """Lines with envelope, ``reason`` and event time ``ts``. Late and early lines are
    classified here, before any watermark could drop them without a count."""
    now = now_seconds if now_seconds is not None else F.unix_timestamp(F.current_timestamp())
    checked = classify_lines(drop_overlong(lines), now)
    return checked.withColumn("ts", F.timestamp_micros((F.col("ts_ns").try_cast("decimal(38,0)") / 1000).try_cast("bigint")))


def stream_dedupe(lines: DataFrame, delay: str = "1 hour") -> DataFrame:
    """One row per (reference, line) among lines less than ``delay`` apart. State holds
    a digest, not the line."""
    keyed = lines.withColumn("_digest", F.sha2(F.concat_ws("\n", "partner_ref", "line"), 256))
    return keyed.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["_digest"]).drop("_digest")


def stream_pair(parsed: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Requests with the response that came within ``delay``; an unanswered request
    comes out alone once the watermark has passed. Reads ``parse_lines`` columns and
    ``ts``."""
    # each side has its own watermark, the slower of which counts: a silent side holds the other back
    sides = parsed.withWatermark("ts", delay).filter(F.col("correlation_id").isNotNull()).select(
        "partner_ref", "correlation_id", "message", "ts", "method", "path", "status_code", "duration_ms"
    )
    asked = (
        sides.filter(F.col("message") == wire.REQUEST_MESSAGE)
        .select("partner_ref", "correlation_id", "method", "path", F.col("ts").alias("asked_at"))
    )
    answered = (
        sides.filter(F.col("message") == wire.RESPONSE_MESSAGE)
        .select(
            F.col("partner_ref").alias("_ref"), F.col("correlation_id").alias("_id"), "status_code", "duration_ms",
            F.col("ts").alias("answered_at"),
        )
    )
    match = (
        (F.col("partner_ref") == F.col("_ref"))
        & (F.col("correlation_id") == F.col("_id"))
        & (F.col("answered_at") >= F.col("asked_at") - F.expr("interval 1 second"))
        & (F.col("answered_at") <= F.col("asked_at") + F.expr(f"interval {delay}"))
    )
    return asked.join(answered, match, "leftOuter").drop("_ref", "_id")
