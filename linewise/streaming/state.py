"""Steps that remember: parts of a line, calls of an exchange, the time of a report.

Each is a stateful processor with a bounded state per key (64 parts or 1 MiB; 20 calls; four
numbers). A key's rows of a micro-batch are read in order without being held together:
if there are more than a few thousand, they wait as sorted runs in the state store (of trails,
in a temporary file) and are merged from there. Silence is measured in event time, by the rows themselves where they
go on and by a timer where they do not, so results do not depend on how rows fell into triggers.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterator, Sequence
from contextlib import ExitStack
from heapq import merge
from io import SEEK_END
from itertools import chain, groupby, islice
from operator import itemgetter
from tempfile import TemporaryFile

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import wire
from ..session import ship_package

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RUN_ROWS, SPOOL_ROWS = 4096, 256
TRAIL_BUCKETS, TRAIL_RUN_ROWS = 1 << 11, 1 << 15


def use_state_store(spark: SparkSession) -> None:
    """Processors with several state variables and timers need the RocksDB store."""
    if "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", ""):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)


class _Ordered(StatefulProcessor):
    """Reads a key's rows by their first column, ``RUN_ROWS`` of them in memory, or
    ``SPOOL_ROWS`` of each run where there are more."""

    columns: tuple[str, ...] = ()
    out: tuple[str, ...] = ()

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spool = handle.getMapState("spool", "run int, block int", "rows binary")
        self.made = Row(*self.out)

    def rows(self, given: Iterator[Row]) -> Iterator[tuple]:
        pick, by = itemgetter(*self.columns), itemgetter(0)

        def run_of() -> list[tuple]:
            return sorted((pick(r) for r in islice(given, RUN_ROWS)), key=by)

        def spooled(run: int, blocks: int) -> Iterator[tuple]:
            for block in range(blocks):
                held = self.spool.getValue((run, block))[0]
                self.spool.removeKey((run, block))
                yield from pickle.loads(held)  # written below, by this processor

        some = run_of()
        if len(some) < RUN_ROWS:
            yield from some
            return
        runs = []
        while some:
            for block, at in enumerate(range(0, len(some), SPOOL_ROWS)):
                self.spool.updateValue((len(runs), block), (pickle.dumps(some[at : at + SPOOL_ROWS]),))
            runs.append(spooled(len(runs), -(-len(some) // SPOOL_ROWS)))
            some = run_of()
        yield from merge(*runs, key=by)

    def ring(self, at_ms: int, before: int | None) -> None:
        """The key's one timer; ``before`` is when it was to ring."""
        if before is not None and before != at_ms:
            self.handle.deleteTimer(before)
        if before != at_ms:
            self.handle.registerTimer(at_ms)

    def close(self) -> None:
        pass


class _Rejoin(_Ordered):
    columns, out = ("pos", "log", "is_last"), ("file", "stream", "pos", "line", "parts")

    def __init__(self, max_parts: int, max_bytes: int, ttl_ms: int | None):
        self.max_parts, self.max_bytes, self.ttl_ms = max_parts, max_bytes, ttl_ms

    def init(self, handle):
        super().init(handle)
        self.waiting = handle.getValueState("waiting", "logs array<string>, first bigint, size bigint", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        held = self.waiting.get()
        logs, first, size = (list(held[0]), held[1], held[2]) if held is not None else ([], 0, 0)
        for pos, log, last in self.rows(rows):
            first = pos if not logs else first
            logs.append(log)
            size += len(log.encode())
            if last or len(logs) >= self.max_parts or size >= self.max_bytes:
                yield self.made(*key, int(first), "".join(logs).removesuffix("\n"), len(logs))
                logs, size = [], 0
        if logs:
            self.waiting.update((logs, int(first), size))
        elif held is not None:
            self.waiting.clear()


def stream_rejoin(
    parts: DataFrame, max_parts: int = wire.MAX_PARTS, max_bytes: int = wire.MAX_LINE_BYTES, ttl_ms: int | None = None
) -> DataFrame:
    """Split lines put together per (file, stream): ``file, stream, pos, line, parts``,
    ``pos`` being the first part's. Parts wait in state until the last one comes; a line ends
    with the part that makes ``max_parts`` or ``max_bytes``, as in the batch operator. With
    ``ttl_ms`` parts of a file that stays silent that long (its end was never written) are forgotten."""
    ship_package(parts.sparkSession)
    use_state_store(parts.sparkSession)
    return parts.groupBy("file", "stream").transformWithState(
        _Rejoin(max_parts, max_bytes, ttl_ms), "file string, stream string, pos bigint, line string, parts int", "append", "ProcessingTime" if ttl_ms else "None"
    )


def _in_order(frames: Iterator[pd.DataFrame], columns: Sequence[str], run_rows: int) -> Iterator[tuple]:
    """The rows of ``frames``, those equal in the first column together and by the second one, ``run_rows`` of
    them and a frame in memory. If there are more they wait as sorted runs in a temporary file of the
    task and are merged from there, ``SPOOL_ROWS`` of each run at once."""
    some, runs = [], []

    def by(row: tuple):
        return row[0] is not None, row[0] or "", row[1]

    def spooled(blocks: list[int]) -> Iterator[tuple]:
        for at in blocks:
            file.seek(at)
            yield from pickle.load(file)  # written below, by this task

    def rows(order: Callable[[pd.DataFrame], np.ndarray] | None = None) -> Iterator[tuple]:
        held = some[0] if len(some) == 1 else pd.concat(some, ignore_index=True)
        at = order(held) if order else slice(None)
        return zip(*(held[c].to_numpy()[at].tolist() for c in columns))

    with ExitStack() as closing:
        for frame in frames:
            some.append(frame)
            if sum(map(len, some)) < run_rows:
                continue
            file = file if runs else closing.enter_context(TemporaryFile())
            run, blocks = sorted(rows(), key=by), []
            file.seek(0, SEEK_END)
            for at in range(0, len(run), SPOOL_ROWS):
                blocks.append(file.tell())
                pickle.dump(run[at : at + SPOOL_ROWS], file)
            runs.append(blocks)
            some = []
        if runs:
            yield from merge(*map(spooled, runs), sorted(rows(), key=by) if some else [], key=by)
        elif some:
            yield from rows(lambda held: np.lexsort((held[columns[1]].to_numpy(), pd.factorize(held[columns[0]])[0])))


class _Trails:
    """Of a bucket of exchanges: what waits of them is one value and has one timeout, the earliest. Rows
    come as frames, as a call of its own for each would cost more than what is done with it."""

    columns, out = ("exchange_id", "seq", "kind", "call_json", "call_bytes", "ms"), ("exchange_id", "answered", "trail_json", "n_calls", "upstream_dropped")

    def __init__(self, max_calls: int, max_bytes: int, wait_ms: int | None, run_rows: int):
        self.max_calls, self.max_bytes, self.wait_ms, self.run_rows = max_calls, max_bytes, wait_ms, run_rows

    def fitted(self, exchange, calls, dropped, answered):
        calls = sorted(calls)
        size = 1 + sum(c[2] + 1 for c in calls)
        first = 0
        while first < len(calls) and size > self.max_bytes:
            size -= calls[first][2] + 1
            first += 1
        return exchange, answered, "[" + ",".join([c[1] for c in calls[first:]]) + "]", len(calls) - first, dropped + first

    def trails(self, waiting, frames):
        """What goes out by rows alone; ``waiting`` then holds what waits: by exchange at most
        ``max_calls`` calls, the number dropped and the latest time."""
        wait_ms = self.wait_ms
        for exchange, its in groupby(_in_order(frames, self.columns, self.run_rows), key=itemgetter(0)):
            calls, dropped, last_ms = waiting.pop(exchange, ([], 0, None))
            for _, seq, kind, text, size, ms in its:
                if wait_ms is not None:
                    ms = int(ms)
                    if (calls or dropped) and ms - last_ms > wait_ms:
                        yield self.fitted(exchange, calls, dropped, False)
                        calls, dropped = [], 0
                    last_ms = ms if last_ms is None else max(last_ms, ms)
                if kind == "call":
                    calls.append((seq, text, int(size)))
                    if len(calls) > self.max_calls:
                        calls.remove(min(calls))
                        dropped += 1
                elif calls or dropped:
                    yield self.fitted(exchange, calls, dropped, kind == "response")
                    calls, dropped = [], 0
            if calls or dropped:
                waiting[exchange] = (calls, dropped, last_ms)

    def silent(self, waiting, now):
        for exchange in [e for e, (_, _, last_ms) in waiting.items() if last_ms + self.wait_ms + 1 < now]:
            calls, dropped, _ = waiting.pop(exchange)
            yield self.fitted(exchange, calls, dropped, False)

    def bucket(self, key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        waiting = pickle.loads(zlib.decompress(state.get[0])) if state.exists else {}  # written below, by this operator
        sent = self.trails(waiting, frames)
        if self.wait_ms is not None:
            sent = chain(sent, self.silent(waiting, state.getCurrentWatermarkMs()))
        while some := list(islice(sent, RUN_ROWS)):
            yield pd.DataFrame(some, columns=list(self.out))
        if waiting:
            state.update((zlib.compress(pickle.dumps(waiting), 1),))  # the states of a partition may ring, and travel, at once
            if self.wait_ms is not None:
                rings = min(last_ms for _, _, last_ms in waiting.values()) + self.wait_ms + 1
                state.setTimeoutTimestamp(max(rings, 1))
        elif state.exists:
            state.remove()


def stream_trails(
    events: DataFrame, max_calls: int = wire.TRAIL_MAX_CALLS, max_bytes: int = wire.TRAIL_MAX_BYTES, wait: str | None = None, delay: str = "1 hour",
    buckets: int = TRAIL_BUCKETS, run_rows: int = TRAIL_RUN_ROWS,
) -> DataFrame:
    """The trail of each exchange, sent out when its response comes. Reads
    ``exchange_id, seq, kind`` (call | response | end), ``call_json`` and ``call_bytes`` (its
    escaped size). An ``end`` sends out what waits with ``answered`` false.

    With ``wait`` the rows also have ``ts``, and an exchange that is silent longer than
    that in event time goes out with ``answered`` false, so that its calls are counted as
    lost: at once when a later row of it shows the gap, else when the watermark, ``delay``
    behind the latest row, has passed. No closing row is needed.

    State is kept by bucket of exchanges: a task holds what waits in one of ``buckets``, which
    stays the same while a query's checkpoint is used, and ``run_rows`` of its rows."""
    spark = events.sparkSession
    ship_package(spark)
    use_state_store(spark)
    if wait is not None:
        events = events.withWatermark("ts", delay).withColumn("ms", F.unix_millis("ts"))
        wait_ms = spark.range(1).select(F.unix_millis(F.timestamp_seconds(F.lit(0)) + F.expr(f"interval {wait}"))).first()[0]
    else:
        events, wait_ms = events.withColumn("ms", F.lit(0).cast("bigint")), None
    # never null, or a frame would hold it as doubles
    seq = F.when(F.col("seq").isNotNull(), F.col("seq")).when(F.col("kind") == "call", F.raise_error(F.lit("a call has no seq"))).otherwise((1 << 63) - 1)
    rows = events.select("exchange_id", seq.cast("bigint").alias("seq"), "kind", "call_json", "call_bytes", "ms", *(["ts"] if wait is not None else []))
    bucket = F.pmod(F.xxhash64("exchange_id"), F.lit(buckets)).alias("bucket")
    return rows.select("*", bucket).groupBy("bucket").applyInPandasWithState(
        _Trails(max_calls, max_bytes, wait_ms, run_rows).bucket, "exchange_id string, answered boolean, trail_json string, n_calls int, upstream_dropped int",
        "waiting binary", "append", GroupStateTimeout.EventTimeTimeout if wait is not None else GroupStateTimeout.NoTimeout,
    )


class _Reports(_Ordered):
    columns, out = ("ms", "n"), ("logger", "at_ms", "reported", "total")

    def __init__(self, interval_ms: int, flush_ms: int | None):
        self.interval_ms, self.flush_ms = interval_ms, flush_ms

    def init(self, handle):
        super().init(handle)
        self.state = handle.getValueState("state", "last bigint, held bigint, total bigint, seen bigint, rings bigint")

    def handleInputRows(self, key, rows, timerValues):
        found = self.state.get()
        last, held, total, seen, rings = found if found is not None else (None, 0, 0, None, None)
        closes = False
        for ms, some in groupby(self.rows(rows), key=itemgetter(0)):  # all drops of one millisecond are one tick
            counts = [n for _, n in some]
            closes = closes or None in counts
            counts = [int(n) for n in counts if n is not None]
            if not counts:
                continue
            if self.flush_ms is not None and held and ms - seen > self.flush_ms:
                yield self.made(*key, None, held, total)
                held = 0
            held, total, seen = held + sum(counts), total + sum(counts), int(ms)
            if last is None or ms - last >= self.interval_ms:
                yield self.made(*key, int(ms), held, total)
                last, held = int(ms), 0
        if closes and held:
            yield self.made(*key, None, held, total)
            held = 0
        if self.flush_ms is not None and held:
            self.ring(seen + self.flush_ms + 1, rings)
            rings = seen + self.flush_ms + 1
        self.state.update((last, held, total, seen, rings))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        last, held, total, seen, _ = self.state.get()
        self.state.update((last, 0, total, seen, None))
        if held:
            yield self.made(*key, None, held, total)


def stream_reports(drops: DataFrame, interval_ms: int = wire.REPORT_INTERVAL_MS, flush_ms: int | None = None, delay: str = "1 hour") -> DataFrame:
    """Rate-limited drop reports per logger: ``logger, at_ms, reported, total``. Reads
    ``logger, ms, n``. A null ``n`` closes the logger: what it holds then is reported with a
    null time.

    With ``flush_ms`` that also happens once a logger has been silent longer than that in
    event time, seen from its next row or from the watermark, ``delay`` behind the latest row.
    Drops of one millisecond that fall into two triggers are two ticks of the same time."""
    ship_package(drops.sparkSession)
    use_state_store(drops.sparkSession)
    rows = drops.select("logger", "ms", "n")
    if flush_ms is not None:
        rows = rows.withColumn("ts", F.timestamp_millis("ms")).withWatermark("ts", delay)
    return rows.groupBy("logger").transformWithState(
        _Reports(interval_ms, flush_ms), "logger string, at_ms bigint, reported bigint, total bigint", "append", "EventTime" if flush_ms is not None else "None"
    )
