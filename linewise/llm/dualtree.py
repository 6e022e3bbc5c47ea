"""Product codes for vectors by Lloyd's rounds, with trees over both the parts and the entries.

Vectors are turned into integers, cut into equal parts and dealt into chunks of a few thousand.
Within a chunk the parts at one position form a tree of bounding boxes, halved along their
widest side; its order is found once and stored with the chunk. In a round each task builds the
same kind of tree over the codebook's entries and walks both together: the least and greatest
distances between two boxes drop the pairs that cannot hold a nearest entry. A box left with
one entry is given to it whole, by the sum and the number of its parts; only boxes of the lowest level
that stay undecided compare their parts with the entries left, in integers. So sums, codes
and errors are exact, whatever the order of rows, tasks or additions.

A round returns a row for each task, position and entry; Spark adds these up, and the driver
holds nothing but the codebooks, whose size does not depend on the data.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewise.llm.stored import stored

CHUNK = 4096
LEAF = 16
Codebooks = list[np.ndarray]


def _halved(points: np.ndarray, leaf: int) -> np.ndarray:
    """An order of the points in which the tree's boxes are stretches: halves along the widest side."""
    order, waiting = np.arange(len(points)), [(0, len(points))]
    while waiting:
        a, b = waiting.pop()
        if b - a <= leaf:
            continue
        own = points[order[a:b]]
        side = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
        middle = (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(own[:, side], middle, kind="introselect")]
        waiting += [(a, a + middle), (a + middle, b)]
    return order


class Boxes:
    """The tree over points in that order: per node its stretch, box, children (-1: none)."""

    def __init__(self, points: np.ndarray, leaf: int):
        spans, left = [(0, len(points))], []
        for a, b in spans:  # grows meanwhile
            if b - a > leaf:
                left.append(len(spans))
                spans += [(a, a + (b - a) // 2), (a + (b - a) // 2, b)]
            else:
                left.append(-1)
        self.start, self.stop = np.array(spans).T
        self.left = np.array(left)
        self.low, self.high = np.zeros((len(spans), points.shape[1]), points.dtype), np.zeros((len(spans), points.shape[1]), points.dtype)
        ends = np.flatnonzero(self.left < 0)
        ends = ends[np.argsort(self.start[ends])]
        self.low[ends] = np.minimum.reduceat(points, self.start[ends])
        self.high[ends] = np.maximum.reduceat(points, self.start[ends])
        for k in range(len(spans) - 1, -1, -1):
            if (c := left[k]) >= 0:
                self.low[k] = np.minimum(self.low[c], self.low[c + 1])
                self.high[k] = np.maximum(self.high[c], self.high[c + 1])


class Entries:
    """A codebook's tree. Entries keep their indexes in ``index``, as ties go to the lower one;
    of equal entries only the first can be chosen, so the others are left out."""

    def __init__(self, book: np.ndarray):
        first = np.sort(np.unique(book, axis=0, return_index=True)[1])
        self.index = first[_halved(book[first], 1)]
        self.points = book[self.index]
        self.tree = Boxes(self.points, 1) if len(book) else None


def _distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points to all entries. Where every number on the way is a whole
    number under 2^53, floating point is exact too, and faster."""
    top = max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0))
    if points.shape[1] * (2 * int(top)) ** 2 < 1 << 53:
        points, entries = points.astype(np.float64), entries.astype(np.float64)
        return ((points**2).sum(axis=1)[:, None] - 2 * (points @ entries.T) + (entries**2).sum(axis=1)).astype(np.int64)
    out = np.zeros((len(points), len(entries)), np.int64)
    for k in range(points.shape[1]):
        out += (points[:, k, None] - entries[:, k]) ** 2
    return out


def assign(points: np.ndarray, entries: Entries) -> Iterator[tuple[int, int, np.ndarray | int]]:
    """Stretches of the points (in the tree's order), each with its nearest entry: one index where a
    box is given as a whole, else an index for each point."""
    if not len(points):
        return
    tree, book = Boxes(points, LEAF), entries.tree
    a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)  # pairs of nodes, by the first
    while len(a):
        gap = np.maximum(0, np.maximum(tree.low[a] - book.high[b], book.low[b] - tree.high[a]))
        reach = np.maximum(tree.high[a] - book.low[b], book.high[b] - tree.low[a])
        near, far = (gap * gap).sum(axis=1), (reach * reach).sum(axis=1)
        cut = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        best = np.repeat(np.minimum.reduceat(far, cut), np.diff(np.append(cut, len(a))))
        # An entry that comes at best as near as another comes at worst loses, unless its index may be lower.
        single = book.left[b] < 0
        index = np.where(single, entries.index[book.start[b]], -1)
        winner = np.where(single & (far == best), index, len(entries.index) + entries.index.max())
        winner = np.repeat(np.minimum.reduceat(winner, cut), np.diff(np.append(cut, len(a))))
        keep = (near < best) | ((near == best) & (index <= winner))
        a, b, single = a[keep], b[keep], single[keep]
        cut = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        size = np.diff(np.append(cut, len(a)))
        decided = (size == 1) & single[cut]
        for k in cut[decided].tolist():
            yield int(tree.start[a[k]]), int(tree.stop[a[k]]), int(entries.index[book.start[b[k]]])
        all_single = np.logical_and.reduceat(single, cut)
        lowest = tree.left[a[cut]] < 0
        for k, n in zip(cut[~decided & all_single & lowest].tolist(), size[~decided & all_single & lowest].tolist()):
            start, stop = int(tree.start[a[k]]), int(tree.stop[a[k]])
            left = np.sort(entries.index[book.start[b[k : k + n]]])
            place = np.argsort(entries.index)  # of an index in the tree's order
            rows = place[np.searchsorted(entries.index[place], left)]
            yield start, stop, left[np.argmin(_distances(points[start:stop], entries.points[rows]), axis=1)]
        open_ = np.repeat(~decided & ~(all_single & lowest), size)
        a, b, single, low = a[open_], b[open_], single[open_], np.repeat(lowest, size)[open_]
        # Entry boxes are opened first; once all are single entries, or the part's box is small, its own halves follow.
        halve = np.repeat(all_single, size)[open_] & ~low
        x = np.concatenate([a[~halve & single], a[~halve & ~single], a[~halve & ~single], tree.left[a[halve]], tree.left[a[halve]] + 1])
        y = np.concatenate([b[~halve & single], book.left[b[~halve & ~single]], book.left[b[~halve & ~single]] + 1, b[halve], b[halve]])
        order = np.argsort(x, kind="stable")
        a, b = x[order], y[order]


def _chunks(batches: Iterator[pa.RecordBatch], parts: int, width: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Rows of up to ``CHUNK`` vectors: ids, labels, integers position by position, each in its tree's order."""

    def whole(some: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(some).combine_chunks()
        values = table["v"].chunk(0).flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
        whole = np.clip(np.floor(1024.0 * values), -limit, limit).astype(np.int32)
        whole = np.pad(whole, ((0, 0), (0, parts * width - whole.shape[1])))
        data, orders = [], []
        for k in range(parts):
            own = whole[:, k * width : (k + 1) * width]
            order = _halved(own, LEAF)
            orders.append(order.astype(np.int32))
            data.append(own[order])
        ids, labels = (pa.ListArray.from_arrays([0, table.num_rows], table[c].chunk(0)) for c in ("id", "label"))
        blobs = [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in (np.stack(data), np.stack(orders))]
        return pa.RecordBatch.from_arrays([ids, labels, *blobs], ["ids", "labels", "data", "orders"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            room = CHUNK - sum(b.num_rows for b in held)
            held.append(batch.slice(0, room))
            batch = batch.slice(held[-1].num_rows)
            if sum(b.num_rows for b in held) == CHUNK:
                yield whole(held)
                held = []
    if held:
        yield whole(held)


def _usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Rows whose vector has components, none of them null, NaN or infinite."""
    v = F.col(vector_col).cast("array<double>")
    narrow = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), v.alias("v"))
    return narrow.filter("size(v) > 0 and forall(v, x -> x is not null and abs(x) < double('infinity'))")


def _unpacker(parts: int, width: int) -> Callable[[bytes], np.ndarray]:
    """From a chunk's bytes to its integers by position, vector and component."""
    return lambda data: np.frombuffer(data, np.int32).reshape(parts, -1, width).astype(np.int64)


class Coder:
    """``fit`` makes the codebooks, ``codes`` the rows. See ``compress`` for what they hold."""

    def __init__(self, vectors: DataFrame, parts: int = 4, entries: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"):
        usable = _usable(vectors, id_col, vector_col, label_col)
        first = usable.orderBy(F.col("id").asc_nulls_last(), F.col("v")).limit(entries).collect()
        self.parts, self.size = parts, len(first[0].v) if first else parts
        self.width = -(-self.size // parts)
        self.limit = math.isqrt((1 << 61) // (parts * self.width)) // 2
        starts = [r.v for r in first if len(r.v) == self.size]
        whole = np.clip(np.floor(1024.0 * np.array(starts, float).reshape(len(starts), self.size)), -self.limit, self.limit).astype(np.int64)
        whole = np.pad(whole, ((0, 0), (0, parts * self.width - self.size)))
        self.books: Codebooks = [np.ascontiguousarray(whole[:, k * self.width : (k + 1) * self.width]) for k in range(parts)]
        parts_, width, limit = parts, self.width, self.limit
        chunked = usable.filter(F.size("v") == self.size).mapInArrow(lambda batches: _chunks(batches, parts_, width, limit), "ids array<long>, labels array<string>, data binary, orders binary")
        self.chunks = stored(chunked, "vector-chunks")

    def round(self) -> None:
        """Assigns every part, then moves each entry to its parts' mean, rounded down."""
        books, width, parts, unpack = self.books, self.width, self.parts, _unpacker(self.parts, self.width)

        def run(batches):
            trees = [Entries(b) for b in books]
            sums = [np.zeros((len(b), width), np.int64) for b in books]
            counts = [np.zeros(len(b), np.int64) for b in books]
            for batch in batches:
                for data in batch.column("data"):
                    for k, points in enumerate(unpack(data.as_py())):
                        before = np.zeros((len(points) + 1, width), np.int64)
                        np.cumsum(points, axis=0, out=before[1:])  # of any stretch the sum is a difference
                        for start, stop, entry in assign(points, trees[k]):
                            if isinstance(entry, int):
                                sums[k][entry] += before[stop] - before[start]
                                counts[k][entry] += stop - start
                            else:
                                np.add.at(sums[k], entry, points[start:stop])
                                np.add.at(counts[k], entry, 1)
            for k in range(parts):
                some = np.flatnonzero(counts[k])
                kind = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), k), pa.int32()), pa.array(some, pa.int32()), pa.array(counts[k][some]), pa.array(sums[k][some].tolist(), kind)], ["part", "entry", "n", "sums"])

        partial = self.chunks.select("data").mapInArrow(run, "part int, entry int, n long, sums array<long>")
        added = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
        moved = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *added).collect()  # parts x entries rows at most
        self.books = [b.copy() for b in books]
        for row in moved:
            self.books[row.part][row.entry] = [int(row[f"s{i}"]) // row.n for i in range(width)]

    def fit(self, rounds: int = 4) -> Coder:
        for _ in range(rounds if len(self.books[0]) else 0):
            self.round()
        return self

    def digest(self) -> str:
        """sha256 of the integers by part, entry and position, joined by commas, in lowercase hex."""
        return hashlib.sha256(",".join(str(x) for b in self.books for x in b.ravel().tolist()).encode()).hexdigest()

    def codes(self) -> DataFrame:
        """``id``, ``label``, ``entries`` (an index for each part) and ``error`` of every usable row."""
        books, parts, unpack = self.books, self.parts, _unpacker(self.parts, self.width)

        def run(batches):
            trees = [Entries(b) for b in books]
            for batch in batches:
                for row in range(batch.num_rows):
                    data = unpack(batch.column("data")[row].as_py())
                    orders = np.frombuffer(batch.column("orders")[row].as_py(), np.int32).reshape(parts, -1)
                    codes, errors = np.zeros((orders.shape[1], parts), np.int32), np.zeros(orders.shape[1], np.int64)
                    for k, points in enumerate(data):
                        entry = np.zeros(len(points), np.int32)
                        for start, stop, found in assign(points, trees[k]):
                            entry[start:stop] = found
                        codes[orders[k], k] = entry
                        errors[orders[k]] += ((points - books[k][entry]) ** 2).sum(axis=1)
                    offsets = np.arange(len(errors) + 1, dtype=np.int32) * parts
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("ids")[row].values, batch.column("labels")[row].values, pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes.ravel())), pa.array(errors)], ["id", "label", "entries", "error"]
                    )

        return self.chunks.mapInArrow(run, "id long, label string, entries array<int>, error long")


def compress(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id``, ``code`` (an entry of each part in two hex digits, for up to 256 entries),
    ``error`` (squared distance to the entries), ``label_error`` (summed over equal labels, nulls
    together) and ``codebooks_sha256`` of every row with a usable vector.

    A component x counts as floor(1024 x). Codebooks start as the parts of the ``entries`` least ids
    (null last; equal ids by their vectors); fewer rows give fewer entries. Ties go to the lower entry, entries without
    parts stay. Vectors that are null or empty, or hold null, NaN or infinite components, are left out;
    so are those that are not as long as the least id's. A length that ``parts`` does not divide is filled up with
    zeros. Components beyond ``Coder.limit`` (2^27 at 64 dimensions) count as that, so that sums
    of squares stay 64-bit numbers. Rows that share an id each get a row; other columns are not
    read. A label's sum beyond 64 bits is null. No usable row gives an empty table."""
    if entries > 256:
        raise ValueError("a code has two hex digits for each part")
    coder = Coder(vectors, parts, entries, id_col, vector_col, label_col).fit(rounds)
    coded = stored(coder.codes(), "vector-codes")
    sums = coded.groupBy("label").agg(F.expr("try_cast(sum(cast(error as decimal(38,0))) as long)").alias("label_error"))
    code = F.array_join(F.transform("entries", lambda e: F.lpad(F.lower(F.hex(e)), 2, "0")), "")
    joined = coded.withColumnRenamed("label", "own").join(sums, F.col("own").eqNullSafe(F.col("label")))
    return joined.select(F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error", F.lit(coder.digest()).alias("codebooks_sha256"))
