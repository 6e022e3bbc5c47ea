"""Near-duplicates: many universal hash minima, bands, signature and full-set checks, components.

1. A text is the set of its word shingles. Texts with equal sets are one class, whose least
   id stands for it in everything that follows.
2. A class's signature holds the minima of ``bands * rows`` universal hash functions over its
   set. Classes that agree in a band (``rows`` minima) share a bucket. With 32 bands of 5, two
   sets at similarity 0.85 share none with probability 4e-9, at 0.8 with 3e-6.
3. Each bucket has one leader, chosen by a hash that differs from band to band, and every
   member is held against it: first by signature (five standard deviations of slack), then by
   the full sets. First one pair for each member, then those whose ends are still apart.
4. What still shares a bucket without being connected is compared in blocks of a bucket's
   members, so no bucket is too large and no link is lost; pairs connected by then are left out.
   There shingles count by half of their bits, which can only find too much, and only a pair
   that still may be a link leaves its block, for the check on full sets.
5. Alternating large-star and small-star rounds give the components.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewise.llm.blocks import Block, blocks, mix, shingle_hashes, whole_hash, word_bounds, word_hashes
from linewise.llm.components import components, with_links
from linewise.llm.stored import stored

BUCKET_BLOCK = 256
_SLICE = 2048


def shingle_sets(block: Block, width: int) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, sorted. Words are runs of bytes other than
    space and 9-13, with A-Z lower-cased; a text of fewer than ``width`` words has one shingle."""
    starts, ends, first = word_bounds(block.data, block.offs)
    words = word_hashes(block.data, starts, ends, fold=True)
    grams = shingle_hashes(words, width)
    out = []
    for a, b in zip(first.tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(grams[a : b - width + 1]))
        elif b > a:
            out.append(np.array([whole_hash(words[a:b])], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


class Signatures:
    """Minima of universal hash functions ``(a * x + b) >> 32``, a odd."""

    def __init__(self, bands: int, rows: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
        self.salt = mix(np.arange(1, bands + 1, dtype=np.uint64))

    def of(self, values: np.ndarray) -> np.ndarray:
        least = None
        for at in range(0, len(values), _SLICE):
            some = values[None, at : at + _SLICE] * self.a[:, None]
            some += self.b[:, None]
            found = (some >> np.uint64(32)).min(axis=1)
            least = found if least is None else np.minimum(least, found)
        return least

    def keys(self, minima: np.ndarray) -> np.ndarray:
        key = self.salt.copy()
        for part in minima.reshape(self.bands, self.rows).T:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + part)
        return key.view(np.int64)


def _sketch(width: int, bands: int, rows: int):
    def run(batches):
        own = Signatures(bands, rows)
        for block in blocks(batches):
            sizes, digests, sigs, keys = [], [], [], []
            for values in shingle_sets(block, width):
                sizes.append(len(values))
                if not len(values):
                    digests.append(None), sigs.append(None), keys.append(None)
                    continue
                digests.append(np.array([values.sum(dtype=np.uint64), mix(values + np.uint64(len(values))).sum(dtype=np.uint64)]).tobytes())
                minima = own.of(values)
                sigs.append(minima.astype(np.uint8).tobytes())
                keys.append(own.keys(minima))
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["id", "n_shingles", "digest", "sig", "keys"],
            )

    return run


def _sets(width: int):
    def run(batches):
        for block in blocks(batches):
            found = shingle_sets(block, width)
            whole, short = [v.tobytes() for v in found], [(v >> np.uint64(32)).astype(np.uint32).tobytes() for v in found]
            yield pa.RecordBatch.from_arrays([block.column("id"), pa.array(whole, pa.binary()), pa.array(short, pa.binary())], ["id", "set", "short"])

    return run


def _alike(least: float):
    """Pairs whose signatures agree in at least a share ``least``."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for k in (2, 3))
                keep = pa.array((a == b).mean(axis=1) >= least)
                yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in (0, 1)], ["a", "b"])

    return run


def _confirmed(num: int, den: int):
    def run(batches):
        for batch in batches:
            left, right = [], []
            for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns)):
                n, m = len(x) // 8, len(y) // 8
                if den * min(n, m) < num * max(n, m):
                    continue
                both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
                both.sort(kind="stable")
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                if den * shared >= num * (n + m - shared):
                    left.append(a), right.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return run


def _across(least: float, num: int, den: int):
    """Within two blocks of a bucket, the pairs of different components whose signatures are
    alike and whose shortened shingles (32 bits each) allow a link: equal shingles are equal
    when shortened, so what is counted is never less than the intersection."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        side, ids, comp = (rows.column(k).to_numpy() for k in ("side", "id", "component"))
        sigs = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint8).reshape(len(ids), -1)
        held = [np.frombuffer(b, np.uint32) for b in rows.column("short").to_pylist()]
        sizes = np.array([len(h) for h in held])
        distinct, places = np.unique(np.concatenate(held), return_inverse=True)
        places = np.split(places, np.cumsum(sizes)[:-1])
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        within = not len(two) and not key[1].as_py()  # else there is nothing across
        mark = np.zeros(len(distinct), dtype=bool)
        left, right = [], []
        for k, i in enumerate(one.tolist()):
            others = one[k + 1 :] if within else two
            others = others[comp[others] != comp[i]]
            near = others[(sigs[others] == sigs[i]).mean(axis=1) >= least]
            mark[places[i]] = True
            for j in near.tolist():
                shared = np.count_nonzero(mark[places[j]])
                if den * shared >= num * (sizes[i] + sizes[j] - shared):
                    left.append(min(ids[i], ids[j]))
                    right.append(max(ids[i], ids[j]))
            mark[places[i]] = False
        return pa.table([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return run


def _pairs(df: DataFrame) -> DataFrame:
    return df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()


def near_copies(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, bands: int = 32, rows: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row. Texts are linked when their
    shingle sets' intersection over union is at least ``num / den``; ``component_id`` is the least
    id that links reach, and ``kept`` says that it is the row's own.

    A null text, or one without words, has the empty set and is linked with nothing. Rows with a
    null id take no part: they are returned with their set's size, a null component and kept.
    Rows that share an id must share their text; they count as one and each gets its row. Only
    the two named columns are read."""
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sketch = stored(
        text.mapInArrow(_sketch(width, bands, rows), "id long, n_shingles long, digest binary, sig binary, keys array<long>"), "sketch"
    )
    some = sketch.filter("digest is not null and id is not null")
    classes = stored(some.groupBy("digest", "n_shingles").agg(F.min("id").alias("rep")), "classes")
    member = some.select("id", "digest", "n_shingles").join(classes, ["digest", "n_shingles"]).select("id", "rep")
    reps = classes.select(F.col("rep").alias("id"))
    sketches = some.select("id", "sig", "keys").join(reps, "id", "left_semi").dropDuplicates(["id"])
    sketches = stored(sketches, "reps")

    member_of = sketches.select("id", F.explode("keys").alias("key"))
    leaders = member_of.groupBy("key").agg(F.min(F.struct(F.xxhash64("key", "id").alias("h"), "id")).alias("top"), F.count("*").alias("n"))
    leaders = stored(leaders.filter("n > 1").select("key", F.col("top.id").alias("leader"), "n"), "leaders")
    inside = stored(member_of.join(leaders, "key"), "buckets")

    share = num / den
    least = share - 5 * math.sqrt(share * (1 - share) / (bands * rows))
    sig = sketches.select("id", "sig")

    def like(pairs: DataFrame) -> DataFrame:
        first = pairs.join(sig.select(F.col("id").alias("a"), F.col("sig").alias("sa")), "a")
        second = first.join(sig.select(F.col("id").alias("b"), F.col("sig").alias("sb")), "b")
        return second.select("a", "b", "sa", "sb").mapInArrow(_alike(least), "a long, b long")

    led = stored(like(_pairs(inside.select(F.col("leader").alias("a"), F.col("id").alias("b")))), "led")
    wanted = inside.select("id").distinct()
    sets = text.join(wanted, "id", "left_semi").dropDuplicates(["id"]).mapInArrow(_sets(width), "id long, set binary, short binary")
    sets = stored(sets, "sets")

    def confirm(pairs: DataFrame, name: str) -> DataFrame:
        first = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("x")), "a")
        second = first.join(sets.select(F.col("id").alias("b"), F.col("set").alias("y")), "b")
        return stored(second.select("a", "b", "x", "y").mapInArrow(_confirmed(num, den), "a long, b long"), name)

    def apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
        """Pairs whose ends are not connected yet."""
        tag = lambda side: found.select(F.col("node").alias(side), F.col("component").alias(f"c{side}"))
        both = pairs.join(tag("a"), "a", "left").join(tag("b"), "b", "left")
        return both.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")

    found = stored(components(confirm(led.groupBy("b").agg(F.min("a").alias("a")), "first")), "components")
    found = stored(with_links(found, confirm(apart(led, found), "second")), "components")

    tagged = inside.join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    # In a bucket of several components only pairs across them are open. The largest component's rows
    # go to each block of the others, and those to each of its blocks, so copies follow the open pairs.
    held = tagged.groupBy("key", "component").agg(F.count("*").alias("m"))
    mixed = held.groupBy("key").agg(F.max(F.struct("m", "component")).alias("top"), F.sum("m").alias("n"), F.count("*").alias("k")).filter("k > 1")
    blocks = lambda n: F.ceil(n / BUCKET_BLOCK).cast("int")
    mixed = stored(mixed.select("key", F.col("top.component").alias("main"), blocks(F.col("top.m")).alias("of_main"), blocks(F.col("n") - F.col("top.m")).alias("of_rest")), "mixed")
    left = tagged.select("key", "id", "component").join(mixed, "key").withColumn("main", F.col("component") == F.col("main"))
    left = left.withColumn("block", F.pmod(F.xxhash64("id", "key"), F.when(F.col("main"), F.col("of_main")).otherwise(F.col("of_rest"))).cast("int"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    deal = lambda cross, i, j, side: F.struct(F.lit(cross).alias("cross"), i.alias("i"), j.alias("j"), F.lit(side).alias("side") if isinstance(side, int) else side.alias("side"))
    block = F.col("block")
    to_rest = F.transform(upto("of_rest"), lambda q: deal(True, block, q, 0))
    to_main = F.transform(upto("of_main"), lambda p: deal(True, p, block, 1))
    to_others = F.transform(upto("of_rest"), lambda q: deal(False, F.least(block, q), F.greatest(block, q), F.when(block <= q, 0).otherwise(1)))
    places = F.explode(F.when(F.col("main"), to_rest).otherwise(F.concat(to_main, to_others))).alias("at")
    left = left.join(sketches.select("id", "sig"), "id").join(sets.select("id", "short"), "id")
    dealt = left.select("key", "id", "component", "sig", "short", places).select("key", "id", "component", "sig", "short", "at.*")
    rest = dealt.groupBy("key", "cross", "i", "j").applyInArrow(_across(least, num, den), "a long, b long").distinct()
    rest = stored(rest.join(led.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"), "rest")
    found = stored(with_links(found, confirm(rest, "third")), "components")

    of = member.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select("id", F.coalesce("component", "rep").alias("component"))
    # A component's least id is the least of its classes' least ids, as each class is named by its own.
    out = sketch.select("id", "n_shingles").join(of.dropDuplicates(["id"]), "id", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row for each group of near-copies: the one with the least id. Rows
    that share an id are one document and leave one row; rows without an id all stay."""
    kept = near_copies(docs, id_col=id_col, text_col=text_col, **options).filter("kept and doc_id is not null").select(F.col("doc_id").alias("_llm_id")).distinct()
    named = docs.withColumn("_llm_id", F.col(id_col).cast("long"))
    rest = named.filter(F.col("_llm_id").isNotNull()).join(stored(kept, "kept"), "_llm_id", "left_semi").dropDuplicates(["_llm_id"])
    return rest.select(*docs.columns).unionByName(docs.filter(F.col(id_col).isNull()))
