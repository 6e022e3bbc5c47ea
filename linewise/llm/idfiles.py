"""Token ids on disk, with a minimal perfect hash from document keys to places.

A file set is a Parquet table of shards, each a range of ascending keys: raw little-endian
ids end to end (16 bits where every id fits, else 32), each document's key and end, and an
index. The index hashes a key to a bucket, the bucket's number displaces the key to a slot, and
slots are as many as keys: compress-hash-displace, where a bucket of one key names its free
slot outright. A slot stores the key's fingerprint, so that a key that was never put in is
(but for one in 2^32) refused, and the number of the key's first document. Finding a shard is a
comparison of key ranges that Parquet's statistics answer; finding a document in it takes two
hashes and three entries of its index, whatever its size. Nothing of the file set passes through the driver.
"""

from __future__ import annotations

import zlib
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linewise.llm.blocks import blocks, mix
from linewise.llm.wordids import word_ids

SHARD_IDS = 1 << 20
#: Characters of a text that order it among those of its key; what ranges are drawn from passes through the driver.
HEAD = 64
BUCKET_KEYS = 2
#: So many keys are each a filter of their own in a lookup; more are filtered by their range and then by the tasks.
MANY_KEYS = 200
_TRIES = np.arange(32, dtype=np.uint64)
_DIRECT = 1 << 31


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys."""

    def __init__(self, seeds: np.ndarray, prints: np.ndarray):
        self.seeds, self.prints = seeds, prints

    @staticmethod
    def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
        return (mix(keys ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(buckets)).astype(np.int64)

    @staticmethod
    def _slot(keys: np.ndarray, seed, n: int) -> np.ndarray:
        return (mix(keys + (np.asarray(seed, np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(n)).astype(np.int64)

    @staticmethod
    def _print(keys: np.ndarray) -> np.ndarray:
        return (mix(keys * np.uint64(0xDA942042E4DD58B5) + np.uint64(1)) >> np.uint64(32)).astype(np.uint32)

    @classmethod
    def build(cls, keys: np.ndarray) -> tuple[PerfectHash, np.ndarray]:
        """The hash, and each key's slot. Buckets are placed from the largest down; about an eighth
        of the keys have one of their own, so that slots are left for the last larger ones."""
        keys = keys.astype(np.uint64)
        n = len(keys)
        buckets = max(1, -(-n // BUCKET_KEYS))
        seeds, slots, free = np.zeros(buckets, np.uint32), np.zeros(n, np.int64), np.ones(n, dtype=bool)
        bucket = cls._bucket(keys, buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        sizes = np.diff(cuts)
        for b in np.argsort(-sizes, kind="stable").tolist():
            if sizes[b] < 2:
                break
            own = keys[order[cuts[b] : cuts[b + 1]]]
            seed = np.uint64(0)
            while True:  # many seeds at a time, of which the first that fits is taken
                at = cls._slot(own[None, :], (seed + _TRIES)[:, None], n)
                spread = np.sort(at, axis=1)
                fits = np.flatnonzero(free[at].all(axis=1) & (spread[:, 1:] != spread[:, :-1]).all(axis=1))
                if len(fits):
                    break
                seed += np.uint64(len(_TRIES))
            seed, at, own = seed + fits[0], at[fits[0]], order[cuts[b] : cuts[b + 1]]
            seeds[b], slots[own] = seed, at
            free[at] = False
        single = np.flatnonzero(sizes == 1)
        rest = np.flatnonzero(free)[: len(single)]
        seeds[single] = rest.astype(np.uint32) | np.uint32(_DIRECT)
        slots[order[cuts[single]]] = rest
        prints = np.zeros(n, np.uint32)
        prints[slots] = cls._print(keys)
        return cls(seeds, prints), slots

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's slot, or -1 where its fingerprint is not there."""
        keys = keys.astype(np.uint64)
        n = len(self.prints)
        if not n:
            return np.full(len(keys), -1, np.int64)
        seed = self.seeds[self._bucket(keys, len(self.seeds))]
        direct = seed >= _DIRECT
        slot = np.where(direct, (seed & np.uint32(_DIRECT - 1)).astype(np.int64), self._slot(keys, np.where(direct, 0, seed), n))
        return np.where(self.prints[slot] == self._print(keys), slot, -1)


_SHARD = pa.schema([
    ("part", pa.int32()), ("shard", pa.int32()), ("before", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("least_key", pa.int64()), ("last_key", pa.int64()),
    ("width", pa.int32()), ("ends", pa.binary()), ("keyless", pa.int64()), ("keys", pa.binary()), ("seeds", pa.binary()), ("prints", pa.binary()), ("firsts", pa.binary()), ("ids", pa.binary()),
])
_DDL = (
    "part int, shard int, before long, n_docs long, n_ids long, least_key long, last_key long, width int, ends binary, keyless long, "
    "keys binary, seeds binary, prints binary, firsts binary, ids binary"
)


def _shard(part: int, number: int, before: int, keys: list, texts: list[bytes]) -> pa.RecordBatch:
    """One shard: documents without a key first, then ascending keys; equal keys are next to
    each other, and the index names the first."""
    ids = np.frombuffer(b"".join(texts), "<u4")
    ends = np.cumsum([len(t) // 4 for t in texts], dtype=np.int64)
    keyless = sum(k is None for k in keys)
    distinct, first = np.unique(np.array(keys[keyless:], np.int64), return_index=True)
    index, slots = PerfectHash.build(distinct.view(np.uint64))
    firsts = np.zeros(len(distinct), np.int64)
    firsts[slots] = first + keyless
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    row = (
        part, number, before, len(keys), len(ids), int(distinct[0]) if len(distinct) else None, int(distinct[-1]) if len(distinct) else None, width,
        ends.tobytes(), keyless, np.array(keys[keyless:], np.int64).tobytes(), index.seeds.tobytes(), index.prints.tobytes(), firsts.tobytes(), ids.astype(f"<u{width}").tobytes(),
    )
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _SHARD.types)], schema=_SHARD)


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, shard_ids: int = SHARD_IDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the ids of every row's text, and ``end_id`` after each, in ascending key order.

    A null text is empty; rows with a null key come first and are in no index; rows that share
    a key are all kept, in the order of their texts' first ``HEAD`` characters and then of a hash.
    No key is held by one task: ranges are cut within a key and within equal texts too. Only the
    two named columns are read."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        part, number, before = TaskContext.get().partitionId(), 0, 0
        keys, texts, size = [], [], 0
        for block in blocks(batches):
            for key, ids in zip(block.column("id").to_pylist(), word_ids(tokenizer).encode(block)):
                # Equal keys stay in one shard, unless they alone would fill it.
                if size >= shard_ids and (key != keys[-1] or size >= 8 * shard_ids):
                    yield _shard(part, number, before, keys, texts)
                    number, before = number + 1, before + size
                    keys, texts, size = [], [], 0
                keys.append(key)
                texts.append(ids + end)
                size += len(ids) // 4 + 1
        if keys:
            yield _shard(part, number, before, keys, texts)

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select("*", F.substring("text", 1, HEAD).alias("head"), F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    order = (F.col("id").asc_nulls_first(), F.col("head"), F.col("hash"), F.col("row"))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "text")
    ordered.mapInArrow(run, _DDL).write.option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``start``, the number of ids in all shards before. One number for each
    part file is added up in order; a part is a range of keys, as many as tasks wrote."""
    shards = spark.read.schema(_DDL).parquet(path)
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    return shards.join(F.broadcast(bases), "part").withColumn("start", F.col("base") + F.col("before")).drop("base")


def _ids(row: dict, a: int, b: int) -> np.ndarray:
    return np.frombuffer(row["ids"], f"<u{row['width']}", b - a, a * row["width"]).astype("<u4")


def _spans(row: dict, keys: np.ndarray) -> list[tuple[int, int, int]]:
    """``(position of the key, from, to)`` of the first document of each key that is there."""
    index = PerfectHash(np.frombuffer(row["seeds"], np.uint32), np.frombuffer(row["prints"], np.uint32))
    slots = index.find(keys)
    ends, firsts = np.frombuffer(row["ends"], np.int64), np.frombuffer(row["firsts"], np.int64)
    number = firsts[slots[slots >= 0]]
    starts = np.where(number > 0, ends[number - 1], 0)
    return list(zip(np.flatnonzero(slots >= 0).tolist(), starts.tolist(), ends[number].tolist()))


def lookup(spark: SparkSession, path: str, keys: list[int]) -> DataFrame:
    """``doc_id, ids`` of the first document with each of the given keys that is there.

    First the shards whose key ranges hold some of the keys are asked through their indexes, without
    their ids; then the ids of those shards that answered are read, and of these only the spans.
    Every key range is a filter that Parquet's statistics decide, so far-apart keys do not open what
    lies between them."""
    wanted = np.unique(np.array(keys, np.int64))
    if not len(wanted):
        return spark.createDataFrame([], "doc_id long, ids array<long>")

    def places(batches):
        for batch in batches:
            for row in batch.to_pylist():
                own = wanted[(wanted >= row["least_key"]) & (wanted <= row["last_key"])]
                found = _spans(row, own.view(np.uint64))
                at = [pa.array([row[c]] * len(found), pa.int32()) for c in ("part", "shard")]
                spans = [pa.array([f[k] for f in found], pa.int64()) for k in (1, 2)]
                yield pa.RecordBatch.from_arrays([pa.array(own[[k for k, _, _ in found]] if found else [], pa.int64()), *at, *spans], ["doc_id", "part", "shard", "a", "b"])

    def ids(batches):
        for batch in batches:
            for row in batch.to_pylist():
                held = [(s["doc_id"], _ids(row, s["a"], s["b"]).tolist()) for s in row["spans"]]
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in held], pa.int64()), pa.array([i for _, i in held], pa.list_(pa.int64()))], ["doc_id", "ids"])

    shards = spark.read.schema(_DDL).parquet(path)
    near = reduce(or_, [(F.col("last_key") >= int(k)) & (F.col("least_key") <= int(k)) for k in wanted]) if len(wanted) <= MANY_KEYS else (
        (F.col("last_key") >= int(wanted[0])) & (F.col("least_key") <= int(wanted[-1]))
    )
    index = shards.filter(near).select("part", "shard", "least_key", "last_key", "ends", "seeds", "prints", "firsts")
    found = index.mapInArrow(places, "doc_id long, part int, shard int, a long, b long")
    first = found.groupBy("doc_id").agg(F.min_by(F.struct("part", "shard", "a", "b"), F.struct("part", "shard")).alias("s"))  # a key may span shards and parts
    asked = first.groupBy("s.part", "s.shard").agg(F.collect_list(F.struct("doc_id", "s.a", "s.b")).alias("spans"))
    return shards.select("part", "shard", "width", "ids").join(asked, ["part", "shard"]).mapInArrow(ids, "doc_id long, ids array<long>")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """What the files hold for every document: ``doc_id, start, n_tokens, ids_crc32``. Each
    distinct key is found through its shard's index, and documents that share it follow the
    first; documents without a key are found by their place."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                held = np.frombuffer(row["keys"], np.int64)
                distinct, times = np.unique(held, return_counts=True)
                index = PerfectHash(np.frombuffer(row["seeds"], np.uint32), np.frombuffer(row["prints"], np.uint32))
                slots = index.find(distinct.view(np.uint64))
                if (slots < 0).any():
                    raise ValueError(f"part {row['part']}, shard {row['shard']}: a key is not in its index")
                first = np.frombuffer(row["firsts"], np.int64)[slots]
                number = np.repeat(first, times) + np.arange(len(held)) - np.repeat(np.cumsum(times) - times, times)
                number = np.concatenate([np.arange(row["keyless"]), number]).astype(np.int64)
                ends = np.frombuffer(row["ends"], np.int64)
                starts = np.where(number > 0, ends[number - 1], 0)
                sums = [zlib.crc32(_ids(row, a, b)) for a, b in zip(starts.tolist(), ends[number].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([None] * row["keyless"] + np.repeat(distinct, times).tolist(), pa.int64()), pa.array(row["start"] + starts),
                        pa.array(ends[number] - starts), pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return read_shards(spark, path).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
