"""Secrets of a tenant in its lines: an index of short anchors, lines that never move.

"Contains" alone is a nested loop of all lines and all secrets. Of every secret the eight bytes
that fewest secrets of its tenant share are its anchor (a shorter secret is its own). Each
anchor's hashes set a few bits of a map, of 32 bits an anchor; that map, and nothing else, goes to
all tasks. A task looks at every eight bytes of its lines at once, in numpy, and gives out the
bytes around those whose bits are all set: the true finds and a few chance ones. These
meet the secrets on (tenant, anchor) and are compared in full, so nothing is missed or invented,
and the work grows with the lines' length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package

WIDTH = 8
MAP_BITS, MOST_BITS = 1 << 24, 1 << 28  # 2 MB to 32 MB
BITS_EACH, HASHES = 32, 6
BLOCK_BYTES = 1 << 20


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _hashed(values: np.ndarray, tenants: np.ndarray, width: int) -> np.ndarray:
    """A hash of each anchor (up to eight bytes as a little-endian number)."""
    return _spread(values + _spread(tenants + np.uint64(width)))


def _bit(hashed: np.ndarray, k: int, size: int) -> np.ndarray:
    """The ``k``-th bit of the map for each hash."""
    return ((_spread(hashed + np.uint64(k)) if k else hashed) % np.uint64(size)).astype(np.int64)


def anchors(secrets: DataFrame) -> DataFrame:
    """``secrets`` (tenant_id, form, secret) with ``raw`` (its bytes), ``anchor`` and ``at``, the
    place of the anchor in them. Empty secrets, and those of no tenant, are in no line."""
    known = secrets.select("tenant_id", "form", F.encode("secret", "UTF-8").alias("raw")).filter("octet_length(raw) > 0 and tenant_id is not null").distinct()
    places = F.sequence(F.lit(1), F.greatest(F.octet_length("raw") - (WIDTH - 1), F.lit(1)))
    every = known.select("*", F.explode(places).alias("at")).withColumn("anchor", F.expr(f"substring(raw, at, {WIDTH})"))
    shared = every.groupBy("tenant_id", "anchor").agg(F.count(F.lit(1)).alias("times"))
    rarest = F.min_by(F.struct("anchor", "at"), F.struct("times", "at")).alias("best")
    return every.join(shared, ["tenant_id", "anchor"]).groupBy("tenant_id", "form", "raw").agg(rarest).select("tenant_id", "form", "raw", "best.anchor", (F.col("best.at") - 1).alias("at"))


def _numbers(anchors_: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(a.ljust(WIDTH, b"\0") for a in anchors_), "<u8")


def _words(size: int):
    """The words of the map that a task's anchors set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("anchor").to_pylist()
            widths, values = np.array([len(a) for a in held], np.int64), _numbers(held)
            tenants = batch.column("tenant").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            hashed = np.concatenate([_hashed(values[widths == w], tenants[widths == w], w) for w in range(1, WIDTH + 1)])
            bits = np.concatenate([_bit(hashed, k, size) for k in range(HASHES)])
            words = np.zeros(size // 64, np.uint64)
            np.bitwise_or.at(words, bits // 64, np.uint64(1) << (bits % 64).astype(np.uint64))
            some = np.flatnonzero(words)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(words[some].view(np.int64))], ["word", "bits"])

    return run


def _candidates(words, widths: list[int], before: int, after: int):
    """Wherever all bits of a line's bytes are set in the map: the anchor, and the bytes around it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 64 * len(words.value)
        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
            start, done = 0, 0
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(ends, done + BLOCK_BYTES, "right")))
                yield from block(batch.slice(start, stop - start), size)
                start, done = stop, int(ends[stop - 1])

    def is_set(hashed: np.ndarray, k: int, size: int) -> np.ndarray:
        bits = _bit(hashed, k, size)
        return (words.value[bits // 64] >> (bits % 64).astype(np.uint64) & np.uint64(1)).astype(bool)

    def block(rows: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
        column = rows.column("text").cast(pa.large_binary())
        _, offs, data = column.buffers()
        offs = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1]
        raw = memoryview(data)[offs[0] : offs[-1]] if data is not None else memoryview(b"")
        offs, n = offs - offs[0], len(raw)
        padded = np.concatenate([np.frombuffer(raw, np.uint8), np.zeros(WIDTH, np.uint8)])
        every = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, WIDTH)[:n]).view("<u8").ravel()
        line = np.repeat(np.arange(len(rows)), np.diff(offs))
        tenants = rows.column("tenant").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)[line]
        left = offs[1:][line] - np.arange(n)
        at, wide = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for width in widths:
            values = every if width == WIDTH else every & np.uint64((1 << 8 * width) - 1)
            hashed = _hashed(values, tenants, width)
            hit = np.flatnonzero(is_set(hashed, 0, size) & (left >= width))
            for k in range(1, HASHES):
                hit = hit[is_set(hashed[hit], k, size)]
            at.append(hit)
            wide.append(np.full(len(hit), width))
        at, wide = np.concatenate(at), np.concatenate(wide)
        own = line[at]
        first, last = np.maximum(at - before, offs[own]), np.minimum(at + after, offs[own + 1])
        raw = bytes(raw)
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("line").take(pa.array(own)), rows.column("tenant_id").take(pa.array(own)),
                pa.array([raw[a : a + w] for a, w in zip(at.tolist(), wide.tolist())], pa.binary()),
                pa.array([raw[a:b] for a, b in zip(first.tolist(), last.tolist())], pa.binary()), pa.array(at - first, pa.int32()),
            ],
            ["line", "tenant_id", "anchor", "around", "place"],
        )

    return run


def leak_scan(lines: DataFrame, secrets: DataFrame, line_id: str = "line_id", map_bits: int | None = None) -> DataFrame:
    """(line_id, tenant_id, form) for every line holding a secret of its tenant, once each.

    ``map_bits`` is the size of the map (a multiple of 64), else it follows the number of secrets, up to
    ``MOST_BITS``. In a map too small for them more chance finds travel, and are refused, but the result is the same. A line
    without text, tenant or id holds nothing that could be named."""
    spark = lines.sparkSession
    ship_package(spark)
    known = cut_lineage(anchors(secrets))
    shape = known.agg(F.sort_array(F.collect_set(F.octet_length("anchor"))), F.max("at"), F.max(F.octet_length("raw") - F.col("at")), F.count(F.lit(1))).first()
    if map_bits is None:
        map_bits = min(max(MAP_BITS, 1 << (BITS_EACH * shape[3] - 1).bit_length()), MOST_BITS) if shape[3] else MAP_BITS
    widths, before, after = shape[0], shape[1] or 0, shape[2] or 0
    tenant = F.xxhash64(F.col("tenant_id").cast("string")).alias("tenant")
    set_words = known.select(tenant, "anchor").mapInArrow(_words(map_bits), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    held = set_words.toArrow()  # map_bits / 64 rows at most
    words = np.zeros(map_bits // 64, np.uint64)
    words[held["word"].to_numpy()] = held["bits"].to_numpy().view(np.uint64)
    kinds = dict(lines.dtypes)
    texts = lines.select(F.col(line_id).alias("line"), "tenant_id", tenant, F.col("line").cast("string").cast("binary").alias("text")).filter("text is not null and tenant_id is not null")
    near = texts.mapInArrow(
        _candidates(spark.sparkContext.broadcast(words), widths, before, after), f"line {kinds[line_id]}, tenant_id {kinds['tenant_id']}, anchor binary, around binary, place int"
    )
    same = F.expr("place >= at and substring(around, place - at + 1, octet_length(raw)) = raw")
    found = near.join(known, ["tenant_id", "anchor"]).filter(same)
    return found.select(F.col("line").alias(line_id), "tenant_id", "form").distinct()
