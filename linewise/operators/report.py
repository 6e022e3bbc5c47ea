"""Counts of what was kept, dropped and found."""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from .. import wire
from .greedy import greedy_runs


def rejection_summary(classified: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per export: counts by reason and the text the sender is answered with. Reads
    ``reason`` (null = stored; ``unmatched`` or an invalid-line reason)."""
    reasons = [wire.UNMATCHED, *wire.LINE_REASONS]
    counts = classified.groupBy(*by).agg(
        F.count(F.lit(1)).alias("lines"),
        *[F.count_if(F.col("reason") == r).alias(r) for r in reasons],
    )
    rejected = sum((F.col(r) for r in reasons), F.lit(0))
    invalid = sum((F.col(r) for r in wire.LINE_REASONS), F.lit(0))
    names = F.concat_ws(", ", *[F.when(F.col(r) > 0, r) for r in wire.LINE_REASONS])
    parts = F.concat_ws(
        "; ",
        F.when(F.col(wire.UNMATCHED) > 0, F.concat(F.col(wire.UNMATCHED).cast("string"), F.lit(" " + wire.UNMATCHED_TEXT))),
        F.when(invalid > 0, F.concat(invalid.cast("string"), F.lit(" invalid: "), names)),
    )
    head = F.concat(
        rejected.cast("string"), F.when(rejected == 1, " log record rejected: ").otherwise(" log records rejected: "), parts
    )
    return counts.select(*by, "lines", *reasons, rejected.alias("rejected"), F.when(rejected > 0, head).alias("message"))


def delivery_stats(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Delivered, dropped and lost-call counters. Reads ``drop_reason`` and, when there,
    ``upstream_lost``; nothing waits between batch jobs, so ``buffered`` is 0."""
    lost = F.coalesce(F.sum("upstream_lost"), F.lit(0)) if "upstream_lost" in rows.columns else F.lit(0)
    return rows.groupBy(*by).agg(
        F.lit(0).cast("bigint").alias("buffered"),
        F.count_if(F.col("drop_reason").isNull()).alias("delivered"),
        F.count_if(F.col("drop_reason").isNotNull()).alias("dropped"),
        lost.cast("bigint").alias("upstream_dropped"),
    )


def counters(reason: str = "drop_reason") -> list[Column]:
    """What the live counters count, in one pass with the work itself."""
    return [
        F.count_if(F.col(reason).isNull()).alias("delivered"),
        F.count_if(F.col(reason).isNotNull()).alias("dropped"),
        *[F.count_if(F.col(reason) == r).alias(r) for r in wire.LINE_REASONS],
    ]


def counted(rows: DataFrame, name: str, reason: str = "drop_reason") -> tuple[DataFrame, Observation]:
    """``rows`` unchanged, and an observation whose ``get`` has the counters once the rows have
    been written somewhere. In a stream ``rows.observe(name, *counters(reason))`` says the same
    trigger by trigger, and ``LiveCounters`` adds them up."""
    seen = Observation(name)
    return rows.observe(seen, *counters(reason)), seen


class LiveCounters(StreamingQueryListener):
    """Adds up the counters observed under ``name`` while a stream runs, with the rows and triggers so far."""

    def __init__(self, name: str):
        self.name, self.totals, self.triggers, self.rows = name, Counter(), 0, 0
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        if seen is not None:
            self.totals.update({k: v for k, v in seen.asDict().items() if v})
            self.triggers += 1
            self.rows += event.progress.numInputRows

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))

    def after(self, query: StreamingQuery, seconds: float = 60.0) -> Counter:
        """The totals once the query has ended and its last progress was heard."""
        query.awaitTermination()
        until = time.monotonic() + seconds
        while str(query.runId) not in self.ended and time.monotonic() < until:
            time.sleep(0.05)
        return self.totals


def drop_report(drops: DataFrame, by: Sequence[str], period: Column, at: str, order: Sequence[str]) -> DataFrame:
    """Per group, period and reason: drops, the latest message, and the group's running
    total. The running total is taken over the counts, not over the drops."""
    rows = drops.withColumn("period", period)
    counted = rows.groupBy(*by, "period", "drop_reason").agg(
        F.count(F.lit(1)).alias("entry_count"),
        F.max_by("drop_message", F.struct(F.col(at), *[F.col(o) for o in order])).alias("last_message"),
    )
    so_far = W.partitionBy(*by).orderBy("period", "drop_reason").rowsBetween(W.unboundedPreceding, 0)
    return counted.withColumn("dropped_total", F.sum("entry_count").over(so_far))


def rate_limited_reports(
    drops: DataFrame, by: Sequence[str], at_ms: str, count: Column, interval_ms: int = wire.REPORT_INTERVAL_MS,
    chunk_ms: int = 3_600_000,
) -> DataFrame:
    """When drops are reported: the first at once, later ones held until ``interval_ms``
    after the last report, the rest at the end. Columns: ``at_ms`` (null for the closing
    report), ``reported`` and ``total``.

    Drops of one millisecond are added up first, so a busy logger is at most one row per
    millisecond; reports are then the starts of greedy runs over time."""
    keys = list(by)
    ticks = drops.groupBy(*keys, F.col(at_ms).cast("bigint").alias("_ms")).agg(F.sum(count).alias("_n"))
    runs = greedy_runs(ticks, keys, "_ms", None, interval_ms, None, chunk_ms)
    joined = ticks.join(runs, [*keys, "_ms"])
    # a report carries what was held since the run before it began, and its own tick
    first = F.col("_ms") == F.col("run_start")
    per_run = joined.groupBy(*keys, "run_no", "run_start").agg(
        F.sum(F.when(first, F.col("_n")).otherwise(0)).alias("_own"), F.sum(F.when(~first, F.col("_n")).otherwise(0)).alias("_held")
    )
    chain = W.partitionBy(*keys).orderBy("run_no")
    reports = per_run.withColumn("reported", F.col("_own") + F.coalesce(F.lag("_held").over(chain), F.lit(0)))
    at_report = reports.select(*keys, F.col("run_start").alias("at_ms"), "reported", "run_no")
    closing = (
        reports.groupBy(*keys)
        .agg(F.max_by("_held", "run_no").alias("reported"), (F.max("run_no") + 1).alias("run_no"))
        .filter(F.col("reported") > 0)
        .select(*keys, F.lit(None).cast("bigint").alias("at_ms"), "reported", "run_no")
    )
    total = F.sum("reported").over(chain.rowsBetween(W.unboundedPreceding, 0))
    return at_report.unionByName(closing).select(*keys, "at_ms", "reported", total.alias("total"))


# --- fixed values: redaction markers counted in reports --------------------------
MARKERS = (
    "[JWT_TOKEN_REDACTED]",
    "[TOKEN_REDACTED]",
    "[API_KEY_REDACTED]",
    "[POTENTIAL_KEY_REDACTED]",
    "[ENCODED_KEY_REDACTED]",
    "[EMAIL_REDACTED]",
    "[PASSWORD_REDACTED]",
    "[PHONE_REDACTED]",
    "[CARD_REDACTED]",
    "[CVV_REDACTED]",
    "[IP_REDACTED]",
    "[IPV6_REDACTED]",
    "[ID]",
    "[QUERY_REDACTED]",
    "[REDACTION_FAILED]",
)


def pii_report(redacted: DataFrame, column: str, group: str) -> DataFrame:
    """Rows and hits per marker, for each value of ``group`` and over all (``grp`` null).
    Counts are taken per row before anything is shuffled."""
    hits = F.filter(
        F.transform(
            F.array(*[F.lit(m) for m in MARKERS]),
            lambda m: F.struct(
                m.alias("marker"),
                ((F.length(column) - F.length(F.replace(F.col(column), m, F.lit("")))) / F.length(m)).cast("bigint").alias("hits"),
            ),
        ),
        lambda s: s["hits"] > 0,
    )
    found = redacted.filter(F.contains(F.col(column), F.lit("["))).select(F.col(group).alias("grp"), F.explode(hits).alias("_h"))
    rows = found.select("grp", "_h.marker", "_h.hits")
    return rows.groupingSets([["marker"], ["marker", "grp"]], "marker", "grp").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("hits").alias("hits"), F.grouping("grp").cast("int").alias("all_groups")
    )
