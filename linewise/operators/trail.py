"""The capped trail of upstream calls that a response carries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import wire
from ..functions.calls import call_json, normalised_of_trimmed, reject_reason, strip_url, without_space
from ..functions.jsontext import ascii_length
from .ordered import by_position, running_sum

CALL_COLUMNS = ("name", "method", "url", "status", "duration_ms", "request_id", "error_code", "call_message", "attempt")


def normalise_calls(calls: DataFrame) -> DataFrame:
    """Adds ``call`` (null when rejected) and ``reject_reason``. Reads the columns of
    CALL_COLUMNS; status, duration_ms and attempt are doubles."""
    blanks = {f"_trimmed_{c}": F.trim(c) for c in ("name", "method", "url", "request_id", "error_code")}
    name, method, url, rid, code = texts = [F.col(t) for t in blanks]  # columns of their own, or each use would trim again
    rows = calls.withColumns(blanks).withColumns({t: without_space(text) for t, text in zip(blanks, texts)}).withColumn("_bare_url", strip_url(url))
    reason = reject_reason("name", "method", "url", "status", "duration_ms")
    call = normalised_of_trimmed(name, method, F.col("_bare_url"), rid, code, "status", "duration_ms", "call_message", "attempt")
    return rows.withColumn("reject_reason", reason).withColumn("call", F.when(F.col("reject_reason").isNull(), call)).drop(*blanks, "_bare_url")


def exchange_no(rows: DataFrame, by: Sequence[str] = ("scope_id",), order: str = "seq", chunk: Column | None = None) -> DataFrame:
    """Adds ``exchange_no``: how many responses the scope made before the row. A call
    and the response it ships on have the same number. Reads ``kind``."""
    return running_sum(
        rows, by, [order], chunk if chunk is not None else by_position(order),
        {"exchange_no": F.when(F.col("kind") == "response", 1).otherwise(0)}, before=True,
    )


def union_trails(*trails: DataFrame) -> DataFrame:
    """Calls of several scopes as one; caps and counts apply after this."""
    out = trails[0]
    for more in trails[1:]:
        out = out.unionByName(more)
    return out


def trail_newest(calls: DataFrame, exchange: Sequence[str], order: Sequence[str], max_calls: int) -> DataFrame:
    """The newest ``max_calls`` of each exchange, with ``_rank`` 1 for the newest. Spark
    keeps that many per exchange in every map task already, so an exchange with very
    many calls never meets in one task."""
    newest = W.partitionBy(*exchange).orderBy(*[F.col(o).desc() for o in order])
    return calls.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= max_calls)


def assemble_trails(
    calls: DataFrame,
    exchange: Sequence[str],
    order: Sequence[str] = ("seq",),
    max_calls: int = wire.TRAIL_MAX_CALLS,
    max_bytes: int = wire.TRAIL_MAX_BYTES,
) -> DataFrame:
    """One row per exchange: ``calls`` (ordered array), ``trail_json``, ``n_calls``,
    ``upstream_dropped``, ``truncated``. Reads ``call``.

    First the newest ``max_calls`` stay, then the oldest of those go until the JSON
    array fits ``max_bytes``. Sizes are summed from the newest back, so a call stays
    exactly when it and everything newer fit."""
    keys = list(exchange)
    total = calls.groupBy(*keys).agg(F.count(F.lit(1)).alias("_total"))
    top = trail_newest(calls.select(*keys, *order, "call"), keys, order, max_calls)
    sized = top.withColumn("_json", call_json(F.col("call"))).withColumn("_size", ascii_length("_json") + 1)
    back = W.partitionBy(*keys).orderBy("_rank").rowsBetween(W.unboundedPreceding, 0)
    fits = sized.withColumn("_fits", F.sum("_size").over(back) + 1 <= max_bytes)
    kept = F.sort_array(
        F.collect_list(F.when(F.col("_fits"), F.struct((-F.col("_rank")).alias("_o"), F.col("call").alias("call"), F.col("_json").alias("_json"))))
    )
    trails = fits.groupBy(*keys).agg(kept.alias("_kept"), F.count_if("_fits").cast("int").alias("n_calls"))
    whole = trails.join(total, keys)
    dropped = (F.col("_total") - F.col("n_calls")).cast("int")
    return whole.select(
        *keys,
        F.col("_kept.call").alias("calls"),
        F.concat(F.lit("["), F.array_join("_kept._json", ","), F.lit("]")).alias("trail_json"),
        "n_calls",
        dropped.alias("upstream_dropped"),
        (dropped > 0).alias("truncated"),
    )


def attach_trail(responses: DataFrame, trails: DataFrame, exchange: Sequence[str]) -> DataFrame:
    """Responses with their trail; all trail columns are null where there were no calls."""
    return responses.join(trails, list(exchange), "left")


def orphan_calls(assigned: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How many calls had no response left to ride on. Reads ``fate`` as given by
    ``scopes.assign_calls``."""
    return assigned.filter(F.col("fate") == "lost").groupBy(*by).agg(F.count(F.lit(1)).alias("lost_calls"))


def unanswered_calls(calls: DataFrame, responses: DataFrame, exchange: Sequence[str]) -> DataFrame:
    """Calls of exchanges that have no response."""
    return calls.join(responses.select(*exchange), list(exchange), "left_anti")
