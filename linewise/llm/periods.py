"""Periodic runs of words: Lyndon arrays by grouping, roots extended into runs.

A run is a stretch of words with smallest period q, at least ``max(least, times * q)`` long,
that no neighbouring word extends. Its Lyndon root, under one of two opposite orders of the
words, is the longest Lyndon word at its place. So both Lyndon arrays are taken from phase one
of Baier's suffix sorter (a group's context is the longest Lyndon word at each of its places),
and every root is extended to both sides by longest common extensions. These compare names of
blocks of 2^k words, so they are exact.

Every ``_width`` neighbouring words of a run stand in the text a second time. Only stretches of
words for which that holds (judged by a hash, which never parts equal words) go through the
grouping; a run never leaves such a stretch, so all runs are found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewise.llm.blocks import _ODD, Block, blocks, mix, shingle_hashes, word_bounds, word_hashes

Run = tuple[int, int, int]


def lyndon_lengths(symbols: list[int]) -> list[int]:
    """The length of the longest Lyndon word that starts at each place (an end is smaller than
    any symbol). Groups start as the places of one symbol. From the greatest group down, each
    place points at the nearest place to its left in a smaller group; those pointed at equally
    often from one group become the next greater group, its context longer by as many contexts."""
    n, names = len(symbols), {c: g for g, c in enumerate(sorted(set(symbols)))}
    group = [-1, *map(names.__getitem__, symbols)]  # places count from 1; 0 stands before the text
    members: list[list[int]] = [[] for _ in names]
    for place in range(1, n + 1):
        members[group[place]].append(place)
    size, lower, upper = [1] * len(names), [*range(-1, len(names) - 1)], [*range(1, len(names) + 1)]
    left = [*range(n + 1)]  # itself where a place is still in a smaller group, else a place nearer to such
    g = len(names) - 1
    top = g
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        for i in own:
            left[i] = i - 1
        times: dict[int, int] = {}
        for i in own:
            j = left[i]
            while left[j] != j:
                left[j] = left[left[j]]
                j = left[j]
            left[i] = j
            if j:
                times[j] = times.get(j, 0) + 1
        parts: dict[tuple[int, int], list[int]] = {}
        for j, t in times.items():
            parts.setdefault((t, group[j]), []).append(j)
        for t, h in sorted(parts, reverse=True):
            new, above = len(size), upper[h]
            size.append(size[h] + t * size[g])
            members.append(parts[t, h])
            lower.append(h)
            upper.append(above)
            upper[h] = new
            if h != top:
                lower[above] = new
            for j in parts[t, h]:
                group[j] = new
        g = lower[g]
    return [size[g] for g in group[1:]]


def _block_names(symbols: np.ndarray) -> list[np.ndarray]:
    """For each k, equal numbers for equal blocks of 2^k symbols."""
    names, n = [symbols.astype(np.int32)], len(symbols)
    while 2 << len(names) - 1 <= n:
        half = 1 << len(names) - 1
        last = names[-1].astype(np.int64)
        names.append(np.unique(last[:-half] * (n + 1) + last[half:], return_inverse=True)[1].astype(np.int32))
    return names


def _common(names: list[np.ndarray], a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
    """How many symbols from ``a`` and from ``b`` on (before them where ``back``) are equal; a < b."""
    n, out = len(names[0]), np.zeros(len(a), np.int64)
    for k in range(len(names) - 1, -1, -1):
        x, y = (a - out - (1 << k), b - out - (1 << k)) if back else (a + out, b + out)
        inside = np.flatnonzero((x >= 0) & (y + (1 << k) <= n))
        same = inside[names[k][x[inside]] == names[k][y[inside]]]
        out[same] += 1 << k
    return out


def runs_of(symbols: np.ndarray, least: int, times: int) -> list[Run]:
    """Every run as (start, length, period), by start, then period. ``times`` is 2 at least."""
    n = len(symbols)
    if n < least:
        return []
    names, found = _block_names(symbols), set()
    for order in (symbols, symbols.max(initial=0) - symbols):
        period = np.array(lyndon_lengths(order.tolist()), np.int64)
        at = np.arange(n)
        at = at[at + period < n]
        at = at[symbols[at] == symbols[at + period[at]]]
        period = period[at]
        before, after = _common(names, at, at + period, True), _common(names, at, at + period, False)
        length = before + period + after
        good = length >= np.maximum(least, times * period)
        found.update(zip((at - before)[good].tolist(), length[good].tolist(), period[good].tolist()))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _width(least: int, times: int) -> int:
    """So many neighbouring words of a run are always found one period further on or back."""
    return max(1, min(max(least, times * q) - 2 * q + 1 for q in range(1, least + 2)))


def _stretches(block: Block, least: int, times: int) -> tuple[np.ndarray, np.ndarray, Iterator[tuple[int, int, int]]]:
    """Words' starts and ends, and for each stretch that may hold runs its text, first and last word."""
    starts, ends, first = word_bounds(block.data, block.offs)
    text, width = np.repeat(np.arange(len(block)), np.diff(first)), _width(least, times)
    if len(starts) < least:
        return starts, ends, iter(())
    grams = shingle_hashes(word_hashes(block.data, starts, ends, fold=False), width)
    inside = np.flatnonzero(text[: len(grams)] == text[width - 1 :])
    _, which, count = np.unique(mix(grams[inside] + text[inside].astype(np.uint64) * _ODD), return_inverse=True, return_counts=True)
    again = inside[count[which] > 1]
    fresh = np.concatenate([[True], (np.diff(again) > 1) | (np.diff(text[again]) > 0)]) if len(again) else np.zeros(0, bool)
    cut = np.flatnonzero(fresh)
    a, b = again[cut], again[np.append(cut[1:], len(again)) - 1] + width if len(again) else again
    long = b - a >= least
    return starts, ends, zip(text[a[long]].tolist(), a[long].tolist(), b[long].tolist())


def _block_runs(block: Block, least: int, times: int) -> tuple[dict[int, list[Run]], np.ndarray]:
    """The runs of each text that has some, and the first word of each text."""
    starts, ends, found = _stretches(block, least, times)
    first, out = np.searchsorted(starts, block.offs), {}
    raw = block.data.tobytes()
    for text, a, b in found:
        numbers: dict[bytes, int] = {}
        symbols = np.array([numbers.setdefault(raw[x:y], len(numbers)) for x, y in zip(starts[a:b].tolist(), ends[a:b].tolist())], np.int64)
        base = a - int(first[text])
        if some := [(s + base, length, p) for s, length, p in runs_of(symbols, least, times)]:
            out.setdefault(text, []).extend(some)
    return out, first


def periodic_runs(docs: DataFrame, least: int = 24, times: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (start, length and period in words, by start, then period)
    and ``collapsed``: the words joined by one blank, without those that a run holds after its
    first period. Words are what stands between blanks and the control characters 9 to 13.

    One row for each row of ``docs``, whatever its id; a null or empty text has no words, no runs
    and collapses to the empty text. Other columns are not read. A text is worked on whole, in
    one task, in time that grows as its length (times a logarithm for the extensions)."""
    if least < 2 or times < 2:
        raise ValueError("a run holds two words and two periods at least")

    def run(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for block in blocks(batches):
            found, first = _block_runs(block, least, times)
            collapsed, count = [], np.diff(first)
            for k, text in enumerate(block.texts()):
                words = text.split()
                if k in found:
                    gone = np.zeros(len(words) + 1, np.int64)
                    for start, length, period in found[k]:
                        gone[start + period] += 1
                        gone[start + length] -= 1
                    words = [w for w, g in zip(words, np.cumsum(gone).tolist()) if not g]
                collapsed.append(b" ".join(words))
            runs = [[dict(zip(("start", "length", "period"), r)) for r in found.get(k, ())] for k in range(len(block))]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(count, pa.int64()), pa.array(runs, kind), pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"]
            )

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text``, where for each id with crc32 h of its decimal form, h % 10 = 0
    and g = h // 10, the n words from place a = g % n on repeat the first 1 + (n - a) // (3 + g % 8)
    of them. A row without an id keeps its text."""
    doc_id, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    chosen = docs.select(doc_id.alias("doc_id"), text.alias("text"), F.crc32(doc_id.cast("string").cast("binary")).alias("h"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    due = chosen.withColumn("w", F.when(F.expr("h % 10 = 0"), words)).withColumn("n", F.size("w")).withColumn("g", F.expr("h div 10"))
    due = due.withColumn("a", F.expr("if(n > 0, g % n, 0)")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    changed = F.expr("array_join(transform(sequence(0L, n - 1L), i -> w[cast(if(i < a, i, a + (i - a) % p) as int)]), ' ')")
    return due.select("doc_id", F.when(F.expr("h % 10 = 0 and n > 0"), changed).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """``n_runs``; of the run with the greatest length / period (then the first, then the
    shortest period) ``start``, ``length``, ``period`` and ``exponent_milli``, null without runs;
    ``runs_sha256`` of every ``start,length,period`` and line feed; ``collapsed_sha256``."""
    kind = "struct<start:bigint,length:bigint,period:bigint>"
    best = F.expr(
        f"aggregate(runs, cast(null as {kind}), (b, r) -> "
        "if(b is null or cast(r.length as decimal(19,0)) * b.period > cast(b.length as decimal(19,0)) * r.period, r, b))"
    )
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    out = found.withColumn("best", best)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
