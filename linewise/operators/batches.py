"""Lines grouped for delivery and packed into bounded batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import wire
from ..session import cut_lineage
from .greedy import greedy_runs
from .ordered import by_position, running_sum


def group_for_delivery(entries: DataFrame, app: str = "app_key") -> DataFrame:
    """One row per (app, labels, root): how many lines and bytes, and where its first
    line stands. Reads ``labels, root, line, seq``."""
    return (
        entries.groupBy(app, "labels", "root")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum(F.octet_length("line")).alias("line_bytes"),
            F.min("seq").alias("first_seq"),
        )
        .select(
            app,
            F.col("labels.level").alias("level"),
            F.col("labels.partnerId").alias("partner_id"),
            F.col("labels.direction").alias("direction"),
            F.col("root.upstream_integration").alias("upstream_integration"),
            F.col("root.upstream_base_url").alias("upstream_base_url"),
            "lines",
            "line_bytes",
            "first_seq",
        )
    )


def pack_batches(
    rows: DataFrame,
    keys: Sequence[str],
    order: str,
    size: Column,
    limits: tuple[int, int] = wire.PUSH_BATCH,
    chunk_rows: int = 250_000,
    position_chunk: Column | None = None,
) -> DataFrame:
    """Adds ``batch_no``: each group's rows in order, a new batch when the next row
    would pass the limit of rows or of bytes. A row over the byte limit is a batch of
    its own. ``order`` is a column that is unique in its group."""
    max_rows, max_bytes = limits
    # one short key stands for the group, nulls and nested columns included
    keyed = rows.withColumn("_g", F.md5(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})))
    # all the packing sees is key, position and size, written once: the lines themselves
    # are made and moved only for the final join
    slim = cut_lineage(keyed.select("_g", order, size.alias("_size")))
    chunk = position_chunk if position_chunk is not None else by_position(order)
    ranked = running_sum(slim, ["_g"], [order], chunk, {"_rank": F.lit(1)}, before=True)
    runs = greedy_runs(ranked, ["_g"], "_rank", "_size", max_rows, max_bytes, chunk_rows)
    numbered = ranked.select("_g", order, "_rank").join(runs.select("_g", "_rank", F.col("run_no").alias("batch_no")), ["_g", "_rank"])
    return keyed.join(numbered.drop("_rank"), ["_g", order]).drop("_g")


def export_records(batched: DataFrame, keys: Sequence[str], order: str, line: str = "line") -> DataFrame:
    """One export record per batch: its lines, as written, each the body of a record.
    A batch is bounded, so the list is."""
    lines = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(line).alias("line"))))
    grouped = batched.groupBy(*keys, "batch_no").agg(lines.alias("_l"))
    records = F.transform(
        "_l.line", lambda x: F.struct(F.struct(x.alias("stringValue")).alias("body"))
    )
    body = F.struct(F.array(F.struct(F.array(F.struct(records.alias("logRecords"))).alias("scopeLogs"))).alias("resourceLogs"))
    return grouped.select(*keys, "batch_no", F.size("_l").alias("lines"), F.to_json(body).alias("record"))


def push_batches(batched: DataFrame, app: str, order: str) -> DataFrame:
    """One delivery body per batch: labels, the root fields that are set, and entries
    of timestamp and line. Reads ``labels, root, ts_ns, line, batch_no``."""
    entries = F.array_sort(
        F.collect_list(F.struct(F.col(order).alias("o"), F.col("ts_ns").alias("timestamp"), F.col("line").alias("line")))
    )
    grouped = batched.groupBy(app, "labels", "root", "batch_no").agg(entries.alias("_e"))
    body = F.to_json(
        F.struct(
            "labels",
            F.col("root.upstream_integration").alias("upstream_integration"),
            F.col("root.upstream_base_url").alias("upstream_base_url"),
            F.transform("_e", lambda e: F.struct(e["timestamp"].alias("timestamp"), e["line"].alias("line"))).alias("entries"),
        )
    )
    return grouped.select(app, "labels", "root", "batch_no", F.size("_e").alias("lines"), body.alias("body"))
