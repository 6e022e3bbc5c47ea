"""Greedy cuts of ordered groups, in parallel and exact.

A run starts at a row; the next run starts at the first later row that is
``max_span`` positions on, or at which the run's weight would pass ``max_weight``.
Batches cut by rows and bytes are such runs, and so are reports that wait a minute after
the last one. Where a run starts depends on all runs before it, so the plain method is
one task per group.

Here a group is cut into chunks of at least ``max_span`` positions. A run open at a
chunk's edge started within the last ``max_span`` positions before it, so each chunk,
given the tail of the one before, computes for EVERY possible open start where the runs
stand at its own end. Those small tables are followed chunk by chunk (that is all one
task sees of a group), and then every chunk cuts its own rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package

_FREE = -(1 << 62)  # no run is open at the edge
_KEPT = -1  # the open run is still the open one at the end


def _following(pos: np.ndarray, weight: np.ndarray, max_span: int, max_weight: int, reaching: bool) -> np.ndarray:
    """For each row the index of the row that starts the next run."""
    total = np.concatenate(([0], np.cumsum(weight)))
    by_span = np.searchsorted(pos, pos + max_span, side="left")
    if reaching:
        by_weight = np.searchsorted(total, total[:-1] + max_weight, side="left")
    else:
        by_weight = np.searchsorted(total, total[:-1] + max_weight, side="right") - 1
    return np.maximum(np.minimum(by_span, by_weight), np.arange(len(pos)) + 1)


def _jumps(step: np.ndarray) -> list[np.ndarray]:
    """The starts 1, 2, 4, ... runs on, of every row and of the end (which stays the end)."""
    n = len(step)
    tables = [np.append(np.minimum(step, n), n)]
    while tables[-1][:-1].min(initial=n) < n:
        tables.append(tables[-1][tables[-1]])
    return tables


def _last_starts(jumps: list[np.ndarray], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From each of ``rows`` the last start before the end, and how many runs on it is."""
    n, runs = len(jumps[0]) - 1, np.zeros(len(rows), np.int64)
    for k in range(len(jumps) - 1, -1, -1):
        on = jumps[k][rows]
        inside = on < n
        rows, runs = np.where(inside, on, rows), runs + (inside << k)
    return rows, runs


def _starts_from(jumps: list[np.ndarray], at: int) -> np.ndarray:
    """All starts from ``at`` on: their number doubles with each table."""
    n, found = len(jumps[0]) - 1, np.array([at], np.int64)
    for table in jumps:
        found = np.concatenate((found, table[found]))
        if found[-1] == n:
            break
    return found[found < n]


def _edge_table(pos, weight, edge, max_span, max_weight, reaching):
    """Where runs stand at the end of the rows, for every run that may be open at
    ``edge``: (starts, ends, runs) and the same for no open run, (end, runs).

    A later start never ends earlier, so starts with one outcome are neighbours and only
    the first of each such stretch is kept: a few values per chunk."""
    step = _following(pos, weight, max_span, max_weight, reaching)
    n, first = len(pos), int(np.searchsorted(pos, edge, side="left"))
    jumps = _jumps(step)
    open_ = np.flatnonzero(step[:first] >= first)  # otherwise another run starts before the edge
    last, runs = _last_starts(jumps, open_)
    ends = np.where(last >= first, pos[np.minimum(last, n - 1)] if n else last, _KEPT)
    fresh = np.append(True, (np.diff(ends) != 0) | (np.diff(runs) != 0))[: len(open_)]
    table = list(zip(pos[open_][fresh].tolist(), ends[fresh].tolist(), runs[fresh].tolist()))
    if first == n:
        return table, (_KEPT, 0)
    last, runs = _last_starts(jumps, np.array([first]))
    return table, (int(pos[last[0]]), int(runs[0]) + 1)


def _each_group(frames: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[dict[str, np.ndarray]]:
    """The columns of each group of sorted rows; many small groups cost slices, not frames."""
    held: list[dict[str, np.ndarray]] = []

    def whole() -> dict[str, np.ndarray]:
        return held[0] if len(held) == 1 else {c: np.concatenate([h[c] for h in held]) for c in held[0]}

    for frame in frames:
        if frame.empty:
            continue
        columns = {c: frame[c].to_numpy() for c in frame.columns}
        change = np.zeros(len(frame) - 1, dtype=bool)
        for k in keys:
            change |= (columns[k][1:] != columns[k][:-1]).astype(bool)
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(frame)]
        for a, b in zip(cuts, cuts[1:]):
            part = {c: v[a:b] for c, v in columns.items()}
            if held and (a or any(part[k][0] != held[-1][k][0] for k in keys)):
                yield whole()
                held = []
            held.append(part)
    if held:
        yield whole()


def _batched(groups: Iterator[dict[str, np.ndarray]], rows: int = 20_000) -> Iterator[list[dict[str, np.ndarray]]]:
    some, size = [], 0
    for group in groups:
        some.append(group)
        size += len(group["_pos"])
        if size >= rows:
            yield some
            some, size = [], 0
    if some:
        yield some


def _full(rows: list, schema: T.StructType, least: int = 5_000) -> Iterator[pd.DataFrame]:
    """``rows`` as a frame, and none left, once they are so many."""
    if len(rows) >= least:
        yield pd.DataFrame(rows, columns=[f.name for f in schema.fields], dtype=object)
        rows.clear()


def greedy_runs(
    df: DataFrame, keys: Sequence[str], pos: str, weight: str | None, max_span: int, max_weight: int | None, chunk_span: int,
    reaching: bool = False,
) -> DataFrame:
    """(keys, pos, run_no, run_start) for every row; run_no counts from 0 in each group. With
    ``reaching`` a run ends after the row that brings its weight to ``max_weight``, not before
    the one that would take it beyond.

    ``pos`` is a non-negative integer, unique and never null with its keys. Only keys, positions and
    weights travel; the caller joins the result back or groups by it."""
    ship_package(df.sparkSession)
    names = list(keys)
    span = max(chunk_span, max_span)
    limit = max_weight if max_weight is not None else 1 << 62
    slim = df.select(
        *names, F.col(pos).cast("bigint").alias("_pos"), (F.col(weight) if weight else F.lit(0)).cast("bigint").alias("_w")
    )
    # most groups are one run; that takes only their totals
    totals = slim.groupBy(*names).agg(F.min("_pos").alias("_first"), F.max("_pos").alias("_lastpos"), F.sum("_w").alias("_sum"))
    sized = slim.join(totals, names)
    alone = (F.col("_lastpos") - F.col("_first") < max_span) & ((F.col("_sum") < limit) if reaching else (F.col("_sum") <= limit))
    whole = sized.filter(alone).select(
        *names, F.col("_pos").alias(pos), F.lit(0).cast("bigint").alias("run_no"), F.col("_first").alias("run_start")
    )
    slim = sized.filter(~alone).select(*names, "_pos", "_w")
    own = F.floor(F.col("_pos") / span).cast("bigint")
    in_tail = (F.col("_pos") % span) >= span - max_span
    # a row belongs to its chunk and, when near its end, to the next one's tail
    spread = slim.withColumn("_chunk", F.explode(F.when(in_tail, F.array(own, own + 1)).otherwise(F.array(own))))
    key_fields = [slim.schema[k] for k in names]
    longs = T.ArrayType(T.LongType())
    group_schema = T.StructType(
        [*key_fields, T.StructField("_chunk", T.LongType()), T.StructField("_start", longs), T.StructField("_end", longs),
         T.StructField("_runs", longs), T.StructField("_free_end", T.LongType()), T.StructField("_free_runs", T.LongType())]
    )

    chunk_keys = [*names, "_chunk"]

    def tabulate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = []
        for group in _each_group(frames, chunk_keys):
            table, free = _edge_table(group["_pos"], group["_w"], int(group["_chunk"][0]) * span, max_span, limit, reaching)
            starts, ends, counts = [list(c) for c in zip(*table)] if table else ([], [], [])
            rows.append([*(group[k][0] for k in chunk_keys), starts, ends, counts, *free])
            yield from _full(rows, group_schema)
        yield from _full(rows, group_schema, 1)

    def in_groups(df: DataFrame, by: list[str], *then: str) -> DataFrame:
        return df.repartition(*by).sortWithinPartitions(*by, *then)

    tables = in_groups(spread, chunk_keys, "_pos").mapInPandas(tabulate, group_schema)

    entry_schema = T.StructType(
        [*key_fields, T.StructField("_chunk", T.LongType()), T.StructField("_entry", T.LongType()),
         T.StructField("_run", T.LongType())]
    )

    def follow(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, last, open_start, run = [], None, _FREE, 0
        for frame in frames:
            for row in frame.itertuples(index=False, name=None):
                key, (chunk, starts, ends, counts, free_end, free_runs) = row[: len(names)], row[len(names) :]
                if key != last:
                    last, open_start, run = key, _FREE, 0
                if open_start + max_span <= chunk * span:
                    open_start = _FREE
                out.append([*key, chunk, open_start, run])
                if open_start == _FREE:
                    end, more = free_end, free_runs
                else:
                    at = bisect_right(starts, open_start) - 1
                    end, more = ends[at], counts[at]
                open_start, run = (open_start if end == _KEPT else int(end)), run + int(more)
            yield from _full(out, entry_schema)
        yield from _full(out, entry_schema, 1)

    entries = in_groups(tables, names, "_chunk").mapInPandas(follow, entry_schema)

    run_schema = T.StructType(
        [*key_fields, T.StructField("_pos", T.LongType()), T.StructField("run_no", T.LongType()),
         T.StructField("run_start", T.LongType())]
    )

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in _batched(_each_group(frames, chunk_keys)):
            parts: dict[str, list] = {f.name: [] for f in run_schema.fields}
            for group in some:
                (open_start, run), positions, weights = group["_w"][:2].tolist(), group["_pos"][2:], group["_w"][2:]
                step, n = _following(positions, weights, max_span, limit, reaching), len(positions)
                first = int(np.searchsorted(positions, int(group["_chunk"][0]) * span, side="left"))
                at = first if open_start == _FREE else int(step[int(np.searchsorted(positions, open_start))])
                found = _starts_from(_jumps(step), at) if at < n else np.zeros(0, np.int64)
                which = np.searchsorted(found, np.arange(first, n), side="right") - 1  # -1: the run open at the edge
                starts = np.where(which < 0, open_start, positions[found[np.maximum(which, 0)]] if len(found) else open_start)
                for k in names:
                    parts[k].append(group[k][2 + first :])
                for c, values in (("_pos", positions[first:]), ("run_no", run + which), ("run_start", starts)):
                    parts[c].append(values)
            yield pd.DataFrame({c: np.concatenate(v) for c, v in parts.items()})

    # a chunk's entry goes before its rows, as two of them. It is not joined to them: a join on the same keys
    # takes the place of the exchange, and adaptive execution may then split a chunk over tasks
    heads = entries.select(*chunk_keys, F.inline(F.array(
        F.struct(F.lit(-2).cast("bigint").alias("_pos"), F.col("_entry").alias("_w")), F.struct(F.lit(-1).cast("bigint").alias("_pos"), F.col("_run").alias("_w")),
    )))
    cuts = in_groups(spread.unionByName(heads), chunk_keys, "_pos").mapInPandas(cut, run_schema)
    return whole.unionByName(cuts.withColumnRenamed("_pos", pos))
