"""The whole way of a line: recovered text -> classified, attributed, reported."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import wire
from ..operators.partner import resolve_partner
from ..operators.recover import (
    classify_lines,
    drop_overlong,
    drop_stderr,
    keep_whole_lines,
    marker_version,
    read_cri,
    read_docker_json,
    rejoin_parts,
)
from ..operators.report import rejection_summary


def recover_lines(raw: DataFrame, wrapper: str = "cri", chunk: Column | None = None) -> DataFrame:
    """Container text (file, pos, text) -> whole lines."""
    unwrap = {"cri": read_cri, "docker": read_docker_json}[wrapper]
    lines = rejoin_parts(drop_stderr(unwrap(raw)), chunk=chunk)
    return marker_version(keep_whole_lines(drop_overlong(lines)))


def attribute_lines(lines: DataFrame, apps: DataFrame, now_seconds: Column, previous_tokens: DataFrame | None = None) -> DataFrame:
    """Lines (tenant_id, line) with envelope, ``app_id`` and ``reason``: the first test
    the line fails, or ``unmatched``, or null when it is stored."""
    resolved = resolve_partner(classify_lines(lines, now_seconds), apps, previous_tokens)
    unmatched = F.col("reason").isNull() & F.col("app_id").isNull()
    return resolved.withColumn("reason", F.when(unmatched, wire.UNMATCHED).otherwise(F.col("reason")))


def ingest_report(lines: DataFrame, apps: DataFrame, now_seconds: Column, by: list[str]) -> DataFrame:
    """Per export: counts by reason and the answer's text."""
    return rejection_summary(attribute_lines(lines, apps, now_seconds), by)
