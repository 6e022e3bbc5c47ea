"""Exact substring deduplication by a distributed, common-prefix-aware merge sort of suffixes.

A byte goes when a string of ``length`` bytes over it also starts anywhere else. Sorting a
suffix per byte would move the corpus hundreds of times over, so a sparse suffix array is
sorted: positions are sampled by their content (a position is taken when the least hash among
the next ``tau`` + 1 short strings is at either end of them). Equal texts are sampled alike, and
every window of ``length`` bytes has a sample among its first ``tau`` bytes, so two windows are
equal only if the suffixes at their first samples agree, and what stands before these too.

1. Each part of the documents gives hashes of the bytes that any match of a sample must
   share; a hash that occurs once in the corpus ends its sample's part in the search.
2. The remaining suffixes of a part are sorted and exchanged as front-coded runs: the length
   shared with the suffix before, and the rest. Copies within a part travel once.
3. A loser tree merges the runs of a range. It keeps, at each node, how much of the loser is
   shared with the last winner, and compares bytes only beyond equal shared lengths.
4. Suffixes next to each other that share enough form a cluster; from the shared lengths on
   both sides follow the windows that occur again. The parts mark and cut them.

Ranges are dealt by the hash, so that every range has as much to do, and suffixes that could
share a window meet in one. A cluster is held whole by one task, so a passage that very many documents
hold makes that task's share as large as their number.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewise.llm.blocks import Block, blocks, mix, powers

FLUSH = 1 << 20
_HEAD = np.dtype([("fp", "<u8"), ("shared", "<u2"), ("rest", "<u2"), ("left", "<u2"), ("many", "<u2")])


class Sampling:
    """Sampled positions of a block's texts, and what any match of theirs must share."""

    def __init__(self, length: int):
        if length < 3:
            raise ValueError("strings of fewer than three bytes cannot be sampled")
        self.length = length
        self.gram = max(1, length // 12)
        self.tau = max(1, (length - self.gram) // 2)
        self.least = length - self.tau + 1

    def _hash(self, sums: np.ndarray, down: np.ndarray, starts, width: int) -> np.ndarray:
        return mix((sums[starts + width] - sums[starts]) * down[starts])

    def of(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Position, hash, bytes before it that may belong, and where its text ends."""
        data, offs, n = block.data, block.offs, len(block.data)
        none = np.zeros(0, np.int64)
        if n < self.tau + self.gram:
            return none, none.astype(np.uint64), none, none
        up, down = powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        count = n - self.gram + 1
        grams = (mix((sums[self.gram :] - sums[:count]) * down[:count]) >> np.uint64(32)).astype(np.uint32)
        least, width = grams, 1
        while 2 * width <= self.tau + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        last = self.tau + 1 - width
        least = np.minimum(least[: len(least) - last], least[last:]) if last else least
        at = np.flatnonzero((grams[: len(least)] == least) | (grams[self.tau :] == least))
        text = np.searchsorted(offs, at, "right") - 1
        inside = at + self.tau + self.gram <= offs[text + 1]
        at, text = at[inside], text[inside]
        before = at - offs[text]
        same = np.flatnonzero(text[1:] == text[:-1]) + 1
        before[same] = np.minimum(before[same], at[same] - at[same - 1] - 1)
        before = np.minimum(before, self.tau - 1)
        end = offs[text + 1]
        long = at + self.least <= end
        at, before, end = at[long], before[long], end[long]
        return at, self._hash(sums, down, at, self.least), before, end


def digest(left: bytes, right: bytes) -> int:
    return xxhash.xxh3_64_intdigest(left + right, len(left))


def _hashes(length: int, parts: int):
    def run(batches):
        sampling = Sampling(length)
        held: dict[int, list[np.ndarray]] = {}
        size = 0

        def flush():
            target, part, blob = [], [], []
            for own, arrays in held.items():
                found, times = np.unique(np.concatenate(arrays), return_counts=True)
                found = np.concatenate([found, found[times > 1]])
                goal = (found % np.uint64(parts)).astype(np.int64)
                order = np.argsort(goal, kind="stable")
                found, goal = found[order], goal[order]
                cuts = np.flatnonzero(np.diff(goal)) + 1
                for some in np.split(found, cuts) if len(found) else []:
                    target.append(int(some[0] % np.uint64(parts)))
                    part.append(own)
                    blob.append(some.tobytes())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(target, pa.int32()), pa.array(part, pa.int32()), pa.array(blob, pa.binary())], ["target", "part", "blob"])

        for block in blocks(batches):
            at, hashes, _, _ = sampling.of(block)
            own = block.numbers("part")[np.searchsorted(block.offs, at, "right") - 1] if len(at) else at
            for part in np.unique(own):
                held.setdefault(int(part), []).append(hashes[own == part])
            size += len(at)
            if size >= FLUSH:
                yield flush()
                size = 0
        yield flush()

    return run


def _repeated(batches):
    """Of one range's hashes, those that occur again, for each part that has them."""
    targets: dict[int, list[tuple[int, np.ndarray]]] = {}
    for batch in batches:
        for target, part, blob in zip(*(c.to_pylist() for c in batch.columns)):
            targets.setdefault(target, []).append((part, np.frombuffer(blob, "<u8")))
    for rows in targets.values():
        found, times = np.unique(np.concatenate([a for _, a in rows]), return_counts=True)
        found = found[times > 1]
        if not len(found):
            continue
        part, blob = [], []
        for own, some in rows:
            some = some[found[np.minimum(np.searchsorted(found, some), len(found) - 1)] == some]
            if len(some):
                part.append(own)
                blob.append(np.unique(some).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(blob, pa.binary())], ["part", "blob"])


def _batches(table: pa.Table) -> list[pa.RecordBatch]:
    return [b for b in table.to_batches() if b.num_rows]


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known) or not len(values):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _runs(length: int, parts: int):
    """A part's remaining suffixes as front-coded sorted runs, one for each range."""

    def run(key, docs: pa.Table, hashes: pa.Table) -> pa.Table:
        known = [np.frombuffer(b, "<u8") for b in hashes.column("blob").to_pylist()]
        known = np.unique(np.concatenate(known)) if known else np.zeros(0, np.uint64)
        sampling = Sampling(length)
        found: dict[tuple[int, bytes, bytes, int], int] = {}
        for block in blocks(_batches(docs) if len(known) else []):
            at, own, before, end = sampling.of(block)
            keep = _among(own, known)
            raw = block.data.tobytes()
            for s, fp, b, e in zip(at[keep].tolist(), own[keep].tolist(), before[keep].tolist(), end[keep].tolist()):
                suffix = (fp % parts, raw[s : min(s + length, e)], raw[s - b : s], fp)
                found[suffix] = found.get(suffix, 0) + 1
        target, blob = [], []
        rows: list[tuple] = []
        for suffix in sorted(found):
            if rows and rows[-1][0] != suffix[0]:
                target.append(rows[-1][0])
                blob.append(encode_run(rows, found))
                rows = []
            rows.append(suffix)
        if rows:
            target.append(rows[-1][0])
            blob.append(encode_run(rows, found))
        part = [int(key[0].as_py())] * len(target)
        return pa.table([pa.array(target, pa.int32()), pa.array(part, pa.int32()), pa.array(blob, pa.binary())], ["target", "part", "blob"])

    return run


def shared_length(a: bytes, b: bytes, start: int = 0) -> int:
    """How many leading bytes are equal, those before ``start`` known to be."""
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    odd = int.from_bytes(a[start:n], "little") ^ int.from_bytes(b[start:n], "little")
    return start + ((odd & -odd).bit_length() - 1) // 8


def encode_run(rows: list[tuple], found: dict[tuple, int]) -> bytes:
    head = np.zeros(len(rows), _HEAD)
    body, last = [], b""
    for k, row in enumerate(rows):
        _, right, left, fp = row
        shared = shared_length(last, right)
        head[k] = (fp, shared, len(right) - shared, len(left), min(2, found[row]))
        body += (right[shared:], left)
        last = right
    return len(rows).to_bytes(4, "little") + head.tobytes() + b"".join(body)


def read_run(blob: bytes):
    """The suffixes of a run: ``(right, shared with the one before, left, fp, many)``."""
    n = int.from_bytes(blob[:4], "little")
    head = np.frombuffer(blob, _HEAD, n, 4)
    at, last = 4 + n * _HEAD.itemsize, b""
    for fp, shared, rest, before, many in head.tolist():
        last = last[:shared] + blob[at : at + rest]
        at += rest
        yield last, shared, blob[at : at + before], fp, many
        at += before


def merge_runs(runs: list):
    """The rows of sorted runs in order, as ``(run, row, shared with the row before)``.

    A loser tree: ``loser[k]`` is the run that lost at node k and ``shared[r]`` how much of run
    r's row is shared with the row that beat it there, which is the last one given out."""
    size = 1
    while size < len(runs):
        size *= 2
    rows = [next(r, None) for r in runs] + [None] * (size - len(runs))
    shared = [0 if row else -1 for row in rows]
    loser = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; equal shared lengths are the only reason to look at bytes."""
        if shared[a] != shared[b]:
            return (a, b) if shared[a] > shared[b] else (b, a)
        if shared[a] < 0:
            return a, b
        x, y = rows[a][0], rows[b][0]
        n = shared_length(x, y, shared[a])
        if n == len(x) or (n < len(y) and x[n] < y[n]):
            shared[b] = n
            return a, b
        shared[a] = n
        return b, a

    best = list(range(size))
    level, base = best, size
    while base > 1:
        base //= 2
        won = []
        for k in range(base):
            winner, lost = play(level[2 * k], level[2 * k + 1])
            loser[base + k] = lost
            won.append(winner)
        level = won
    winner = level[0]
    while rows[winner] is not None:
        yield winner, rows[winner], shared[winner]
        row = next(runs[winner], None)
        rows[winner], shared[winner] = row, (row[1] if row else -1)
        node = (winner + size) // 2
        while node:
            other = loser[node]
            if shared[other] > shared[winner]:
                loser[node], winner = winner, other
            elif shared[other] == shared[winner] and shared[winner] >= 0:
                winner, loser[node] = play(winner, other)
            node //= 2


def again(cluster: list[tuple], length: int) -> list[list[tuple[int, int]]]:
    """For each suffix of a cluster ``(right, left, many, shared with the one before)`` the
    ranges of d for which the window that starts d bytes before it occurs again."""
    n = len(cluster)
    if n == 1:
        right, left, many, _ = cluster[0]
        low = max(0, length - len(right))
        return [[(low, len(left))] if many > 1 and low <= len(left) else []]
    rights = np.array([len(c[0]) for c in cluster])
    lefts = np.array([len(c[1]) for c in cluster])
    times = np.array([c[2] for c in cluster])
    shared = np.array([0] + [c[3] for c in cluster[1:]])
    turned = [c[1][::-1] for c in cluster]
    order = sorted(range(n), key=turned.__getitem__)
    near = np.array([0] + [shared_length(turned[a], turned[b]) for a, b in zip(order, order[1:])])
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    points = np.unique(np.concatenate([[0], length - shared[1:], near[1:] + 1, lefts + 1, length - rights]))
    points = points[(points >= 0) & (points <= lefts.max())]
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    ends = [*(points[1:] - 1).tolist(), int(lefts.max())]
    for d, last in zip(points.tolist(), ends):
        fit = np.flatnonzero((d <= lefts) & (length - d <= rights))
        if not len(fit):
            continue
        by_right = np.cumsum(shared < length - d)
        by_left = np.cumsum(near < d)[place]
        both = by_right[fit] * (n + 1) + by_left[fit]
        _, group = np.unique(both, return_inverse=True)
        repeated = np.bincount(group, times[fit])[group] > 1
        for k in fit[repeated].tolist():
            if out[k] and out[k][-1][1] == d - 1:
                out[k][-1] = (out[k][-1][0], last)
            else:
                out[k].append((d, last))
    return out


_FOUND = np.dtype([("fp", "<u8"), ("digest", "<u8"), ("low", "<u2"), ("high", "<u2")])


def _merge(length: int):
    least = Sampling(length).least

    def run(batches):
        targets: dict[int, list[tuple[int, bytes]]] = {}
        for batch in batches:
            for target, part, blob in zip(*(c.to_pylist() for c in batch.columns)):
                targets.setdefault(target, []).append((part, blob))
        for held in targets.values():
            found: dict[int, list[tuple]] = {}
            cluster: list[tuple] = []
            owners: list[tuple[int, int]] = []

            def close():
                for (part, fp), (right, left, _, _), ranges in zip(owners, cluster, again(cluster, length)):
                    if ranges:
                        own = digest(left, right)
                        found.setdefault(part, []).extend((fp, own, low, high) for low, high in ranges)

            for k, (right, _, left, fp, many), shared in merge_runs([read_run(blob) for _, blob in held]):
                if cluster and shared < least:
                    close()
                    cluster, owners = [], []
                cluster.append((right, left, many, shared))
                owners.append((held[k][0], fp))
            if cluster:
                close()
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.int32()), pa.array([np.array(x, _FOUND).tobytes() for x in found.values()], pa.binary())], ["part", "blob"]
            )

    return run


def _cut(length: int):
    """A part's documents with the windows found again taken out."""

    def run(docs: pa.Table, verdicts: pa.Table) -> pa.Table:
        found = [np.frombuffer(b, _FOUND) for b in verdicts.column("blob").to_pylist()]
        found = np.concatenate(found) if found else np.zeros(0, _FOUND)
        known = np.unique(found["fp"])
        ranges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for fp, own, low, high in found.tolist():
            ranges.setdefault((fp, own), []).append((low, high))
        sampling = Sampling(length)
        ids, kept, removed, spans, sizes = [], [], [], [], []
        for block in blocks(_batches(docs)):
            raw, n = block.data.tobytes(), len(block.data)
            edges = np.zeros(n + 1, np.int32)
            if len(known):
                at, fps, before, end = sampling.of(block)
                keep = _among(fps, known)
                for s, fp, b, e in zip(at[keep].tolist(), fps[keep].tolist(), before[keep].tolist(), end[keep].tolist()):
                    for low, high in ranges.get((fp, digest(raw[s - b : s], raw[s : min(s + length, e)])), ()):
                        edges[s - high] += 1
                        edges[s - low + length] -= 1
            gone = np.cumsum(edges[:n]) > 0
            offs = block.offs.tolist()
            for a, b in zip(offs, offs[1:]):
                mask = gone[a:b]
                n_gone = int(np.count_nonzero(mask))
                sizes.append(b - a)
                removed.append(n_gone)
                spans.append(int(np.count_nonzero(mask[1:] & ~mask[:-1])) + int(mask[0]) if n_gone else 0)
                kept.append(block.data[a:b][~mask].tobytes() if n_gone else raw[a:b])
            ids.append(block.column("id"))
        return pa.table(
            [pa.chunked_array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )

    return run


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", digest_only: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept, removed`` of every row: ``kept`` (binary) is the text
    without each byte under a string of ``length`` bytes that also starts anywhere else, in the
    same text or another; with ``digest_only`` ``kept_sha256`` stands in its place; and ``removed``, whether it lost any.

    A null text is empty; texts under ``length`` bytes lose nothing. Rows that share an id, or
    have none, are texts of their own (so a repeated row repeats its text). Only the two named
    columns are read. Texts are bytes of UTF-8; cuts may fall within a character. ``length`` is
    at least 3."""
    Sampling(length)
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id", "text"), F.lit(parts)).cast("int")).repartition(parts, "part")
    by_part = rows.groupBy("part")
    blobs = "target int, part int, blob binary"
    hashes = rows.mapInArrow(_hashes(length, parts), blobs).repartition(parts, "target")
    repeated = hashes.mapInArrow(_repeated, "part int, blob binary")
    runs = by_part.cogroup(repeated.groupBy("part")).applyInArrow(_runs(length, parts), blobs).repartition(parts, "target")
    verdicts = runs.mapInArrow(_merge(length), "part int, blob binary")
    cut = _cut(length)

    def finish(docs: pa.Table, found: pa.Table) -> pa.Table:
        out = cut(docs, found)
        removed = pc.greater(out.column("n_removed"), 0)
        if digest_only:
            sums = [hashlib.sha256(x.as_buffer()).hexdigest() for x in out.column("kept")]
            out = out.drop_columns(["kept"]).append_column("kept_sha256", pa.array(sums, pa.string()))
        return out.append_column("removed", removed)

    last = ("kept_sha256 string" if digest_only else "kept binary") + ", removed boolean"
    return by_part.cogroup(verdicts.groupBy("part")).applyInArrow(finish, f"doc_id long, n_bytes long, n_removed long, n_spans long, {last}")
