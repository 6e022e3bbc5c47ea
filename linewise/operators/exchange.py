"""Requests paired with their responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import wire


def pair_exchanges(
    lines: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = ("partner_ref", "correlation_id"),
    request_columns: Sequence[str] = ("method", "path"),
    response_columns: Sequence[str] = ("status_code", "duration_ms"),
) -> DataFrame:
    """One row per exchange: the first request line and the first response line of each
    key, with ``state`` complete, unanswered or orphan.

    The full outer join of the two sides, as one aggregation: both sides meet in a
    single shuffle, and repeats of a hot key are reduced before it. Reads ``message``;
    a line without correlation id belongs to no exchange."""
    at = F.struct(*[F.col(o) for o in order])
    is_request = F.col("message") == wire.REQUEST_MESSAGE
    is_response = F.col("message") == wire.RESPONSE_MESSAGE
    sides = lines.filter((is_request | is_response) & F.col("correlation_id").isNotNull())
    grouped = sides.groupBy(*keys).agg(
        F.min_by(F.struct(*request_columns), F.when(is_request, at)).alias("_q"),
        F.min_by(F.struct(*response_columns), F.when(is_response, at)).alias("_a"),
        F.count_if(is_request).alias("requests"),
        F.count_if(is_response).alias("responses"),
    )
    state = (
        F.when(F.col("responses") == 0, "unanswered").when(F.col("requests") == 0, "orphan").otherwise("complete")
    )
    return grouped.select(
        *keys,
        *[F.col(f"_q.{c}").alias(c) for c in request_columns],
        *[F.col(f"_a.{c}").alias(c) for c in response_columns],
        state.alias("state"),
    )
