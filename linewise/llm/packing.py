"""Best-fit packing of documents into sequences of a fixed number of tokens (best-two-fit).

Only the number of documents of each length matters for a plan, and there are at most as
many lengths as a sequence has tokens. So the plan is made once, over that histogram: fill a
sequence greedily with the longest document that still fits; where a gap stays, take its
smallest document out again and put in the two unpacked documents that fill the larger gap
best. A sequence's make-up is used as often as the histogram allows at once. The documents
then find their places by their rank among those of their length, in parallel.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linewise.llm.blocks import blocks
from linewise.llm.stored import stored
from linewise.llm.wordids import word_ids

_WIDE = 1 << 40


def pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` with ``part, rank``, its
    number among the pieces of that length in its task.

    A null text is empty and still has the end id; rows that share an id, or have none, are
    documents of their own. Only the two named columns are read."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for block in blocks(batches):
            keys = block.column("doc_id").to_pylist()
            out = []
            for key, ids in zip(keys, word_ids(tokenizer).encode(block)):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    some = ids[at : at + 4 * size]
                    length = len(some) // 4
                    out.append((key, piece, at // 4, length, zlib.crc32(some), part, int(seen[length])))
                    seen[length] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long")


def plan(histogram: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """``[(times, [(length, uses), ...]), ...]``: make-ups of sequences, every document of the
    histogram used once."""
    left = {length: n for length, n in histogram.items() if n > 0}
    free = sum(1 << length for length in left)

    def largest(limit: int) -> int:
        return (free & ((1 << (limit + 1)) - 1)).bit_length() - 1 if limit > 0 else -1

    def take(length: int, n: int = 1) -> None:
        nonlocal free
        left[length] -= n
        if left[length] <= 0:
            free &= ~(1 << length)

    def give(length: int, n: int = 1) -> None:
        nonlocal free
        left[length] += n
        if left[length] > 0:
            free |= 1 << length

    def best_two(gap: int) -> tuple[int, int]:
        """Two unpacked documents whose sum is the largest up to ``gap``."""
        found, first = (0, 0), largest(gap - 1)
        while first > 0 and 2 * first > sum(found):
            if left[first] == 1:
                take(first)
                second = largest(min(first, gap - first))
                give(first)
            else:
                second = largest(min(first, gap - first))
            if second > 0 and first + second > sum(found):
                found = (first, second)
                if sum(found) == gap:
                    break
            first = largest(first - 1)
        return found

    made = []
    while free:
        content: list[int] = []
        gap = size
        while (length := largest(gap)) > 0:
            take(length)
            content.append(length)
            gap -= length
        if gap and content:
            smallest = content[-1]
            two = best_two(gap + smallest)
            if sum(two) > smallest:
                content.pop()
                give(smallest)
                for length in two:
                    take(length)
                content += two
        uses = {length: content.count(length) for length in content}
        more = min(left[length] // n for length, n in uses.items())
        for length, n in uses.items():
            take(length, n * more)
        made.append((1 + more, sorted(uses.items(), reverse=True)))
    return made


def slots(made: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Where the documents of each length go, by rank: rows ``(length, first rank, first
    sequence, uses, offset)`` in order. Of as many rows at most as make-ups times lengths in
    one, whatever the number of documents."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for times, content in made:
        offset = 0
        for length, uses in content:
            rows.append((length, used.get(length, 0), sequence, uses, offset))
            used[length] = used.get(length, 0) + times * uses
            offset += length * uses
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of every document with its sequence: ``doc_id, piece, start, length,
    ids_crc32, sequence_id, offset``. An empty table gives no row."""
    rows = stored(pieces(docs, tokenizer, size, end_id, id_col, text_col), "pieces")
    counts = rows.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}  # at most `size` rows
    table = slots(plan(histogram, size))
    keys = table[:, 0] * _WIDE + table[:, 1]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(k).to_numpy() for k in (3, 5))
            at = np.searchsorted(keys, length * _WIDE + rank, "right") - 1
            past = rank - table[at, 1]
            sequence = table[at, 2] + past // table[at, 3]
            offset = table[at, 4] + past % table[at, 3] * length
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = rows.join(bases, ["part", "length"]).select(*names[:5], (F.col("base") + F.col("rank")).alias("rank"))
    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
