"""Benchmark passages in documents, within an edit budget, by the pigeonhole principle.

An item of n characters may appear with up to k = ``rate`` * n edits. It is cut into k + 1
pieces, of which at least one must then appear unchanged. One Aho-Corasick automaton finds the
pieces in a document; where one is found, the item is held against the text around it by
Myers' bit-parallel distance, for many candidates at once (one numpy lane each, 64 rows of
the matrix per word).

Items go out in blocks of bounded size, each held against all documents; documents are
never moved. Texts are compared with case folded and runs of white space as one blank.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewise.llm.blocks import Block, blocks
from linewise.llm.stored import stored

BLOCK_CHARS = 2_000_000
LANES = 4096
HELD_BYTES = 16 << 20
_ONE = np.uint64(1)
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_WORD = re.compile(r"\S+")


def normal(text: str) -> str:
    """Lower-cased and with single blanks; as long as the text but for white space."""
    return " ".join(text.replace("İ", "i").lower().split())


def places(text: str) -> np.ndarray:
    """For each character of ``normal(text)``, and its end, the place in ``text``."""
    out: list[int] = []
    for m in _WORD.finditer(text):
        if out:
            out.append(m.start() - 1)
        out.extend(range(m.start(), m.end()))
    return np.array([*out, (out[-1] + 1) if out else 0], np.int64)


def myers(eq: np.ndarray, item: np.ndarray, lengths: np.ndarray, texts: np.ndarray, anchored: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Least edit distance of each lane's item to a part of its text, and where the first such
    part ends. ``eq[item, word, code]`` marks the item's rows with that character; ``texts`` holds
    codes, 0 for none of them. ``anchored``: the part starts where the text does."""
    n, words = len(item), eq.shape[1]
    pv, mv = np.full((words, n), _ALL), np.zeros((words, n), np.uint64)
    score = lengths.astype(np.int64).copy()
    best, end = score.copy(), np.zeros(n, np.int64)
    last = (lengths - 1) // 64
    high = _ONE << ((lengths - 1) % 64).astype(np.uint64)
    top = _ONE << np.uint64(63)
    for j in range(texts.shape[1]):
        codes = texts[:, j]
        plus = np.full(n, _ONE if anchored else np.uint64(0))
        minus = np.zeros(n, np.uint64)
        for w in range(words):
            e = eq[item, w, codes]
            p, m = pv[w], mv[w]
            xv = e | m
            e = e | minus
            xh = (((e & p) + p) ^ p) | e
            ph = m | ~(xh | p)
            mh = p & xh
            ends = last == w
            if ends.any():
                score += np.where(ends, ((ph & high) != 0).astype(np.int64) - ((mh & high) != 0), 0)
            more, less = ((ph & top) != 0).astype(np.uint64), ((mh & top) != 0).astype(np.uint64)
            ph, mh = (ph << _ONE) | plus, (mh << _ONE) | minus
            pv[w], mv[w] = mh | ~(xv | ph), ph & xv
            plus, minus = more, less
        better = score < best
        if better.any():
            best[better], end[better] = score[better], j + 1
    return best, end


class Matcher:
    """Finds a block of items ``(item_id, text)`` in documents."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = [(key, normal(text)) for key, text in items]
        self.budget = [int(len(text) * rate) for _, text in self.items]
        held = defaultdict(list)
        for k, ((_, text), budget) in enumerate(zip(self.items, self.budget)):
            n = len(text)
            for i in range(budget + 1):
                a, b = n * i // (budget + 1), n * (i + 1) // (budget + 1)
                held[text[a:b]].append((k, a))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in held.items():
            self.automaton.add_word(piece, (len(piece), owners))
        if held:
            self.automaton.make_automaton()
        letters = sorted({c for _, text in self.items for c in text})
        self.letters = np.array([ord(c) for c in letters], np.uint32)

    def codes(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        at = np.minimum(np.searchsorted(self.letters, raw), len(self.letters) - 1)
        return np.where(self.letters[at] == raw, at + 1, 0)

    def candidates(self, text: str) -> list[tuple[int, int, int]]:
        """``(item, from, to)``: the parts of a text that may hold an item."""
        starts = defaultdict(set)
        for end, (length, owners) in self.automaton.iter(text):
            for k, a in owners:
                starts[k].add(end + 1 - length - a)
        out = []
        for k, found in starts.items():
            n, budget = len(self.items[k][1]), self.budget[k]
            first = last = None
            for start in sorted(found):
                if first is not None and start - first > 2 * budget:
                    out.append((k, max(0, first - budget), min(len(text), last + n + budget)))
                    first = None
                first, last = (start if first is None else first), start
            out.append((k, max(0, first - budget), min(len(text), last + n + budget)))
        return out

    def _lanes(self, which: list[int], parts: list[str], reverse: bool) -> tuple[np.ndarray, np.ndarray]:
        """Distances and ends for ``parts[i]`` against item ``which[i]``."""
        used = sorted(set(which))
        lengths = np.array([len(self.items[k][1]) for k in used])
        eq = np.zeros((len(used), int((lengths.max() + 63) // 64), len(self.letters) + 1), np.uint64)
        for i, k in enumerate(used):
            for row, code in enumerate(self.codes(self.items[k][1][:: -1 if reverse else 1]).tolist()):
                eq[i, row // 64, code] |= _ONE << np.uint64(row % 64)
        place = {k: i for i, k in enumerate(used)}
        texts = np.zeros((len(parts), max(map(len, parts))), np.int64)
        for i, part in enumerate(parts):
            own = self.codes(part)
            texts[i, : len(own)] = own[:: -1 if reverse else 1]
        item = np.array([place[k] for k in which])
        return myers(eq, item, lengths[item], texts, anchored=reverse)

    def verify(self, asked: list[tuple[int, str]]) -> list[tuple[int, int, int] | None]:
        """For each ``(item, part)`` the edits and the span in the part, None over the budget."""
        out: list[tuple[int, int, int] | None] = [None] * len(asked)
        order = sorted(range(len(asked)), key=lambda i: (len(self.items[asked[i][0]][1]), len(asked[i][1])))
        for at in range(0, len(order), LANES):
            some = [i for i in order[at : at + LANES] if asked[i][1]]
            if not some:
                continue
            best, end = self._lanes([asked[i][0] for i in some], [asked[i][1] for i in some], False)
            good = [(i, int(d), int(e)) for i, d, e in zip(some, best, end) if d <= self.budget[asked[i][0]]]
            if good:
                _, back = self._lanes([asked[i][0] for i, _, _ in good], [asked[i][1][:e] for i, _, e in good], True)
                for (i, d, e), length in zip(good, back.tolist()):
                    out[i] = (d, e - length, e)
        return out


_matchers: dict[str, Matcher] = {}


def _matcher(name: str, items: list[tuple[int, str]], rate: float) -> Matcher:
    if name not in _matchers:
        _matchers.clear()
        _matchers[name] = Matcher(items, rate)
    return _matchers[name]


def _verified(matcher: Matcher, held_blocks: Iterator[Block]) -> Iterator[tuple[Block, list[tuple[int, int, int, tuple[int, int, int]]]]]:
    """Each block with what its texts hold: ``(row, item, place in the normal text, found)``. The
    candidates of several blocks are verified at once, as soon as they fill the lanes."""
    held: list[tuple[Block, list[tuple[int, int, int]]]] = []
    asked: list[tuple[int, str]] = []
    size = 0

    def flush():
        answers = iter(matcher.verify(asked))
        for block, where in held:
            yield block, [(*place, found) for place, found in zip(where, answers) if found]
        held.clear()
        asked.clear()

    for block in held_blocks:
        where = []
        for row, text in enumerate(block.texts()):
            plain = normal(text.decode())
            for k, a, b in matcher.candidates(plain):
                asked.append((k, plain[a:b]))
                where.append((row, k, a))
        held.append((block, where))
        size += len(block.data)
        if len(asked) >= LANES or size >= HELD_BYTES:
            yield from flush()
            size = 0
    yield from flush()


def _search(name: str, held, rate: float):
    def run(batches):
        matcher = _matcher(name, held.value, rate)
        for block, found in _verified(matcher, blocks(batches)):
            best: dict[tuple[int, int], tuple[int, int, int]] = {}
            for row, k, a, (edits, start, end) in found:
                best[row, k] = min(best.get((row, k), (edits, a + start, a + end)), (edits, a + start, a + end))
            ids, out, place = block.column("id"), [], {}
            for (row, k), (edits, start, end) in best.items():
                at = place.get(row)
                if at is None:
                    at = place[row] = places(block.data[block.offs[row] : block.offs[row + 1]].tobytes().decode())
                last = int(at[end - 1]) + 1 if end else 0
                out.append((ids[row].as_py(), matcher.items[k][0], edits, len(matcher.items[k][1]), int(at[start]), max(last, int(at[start]))))
            columns = zip(*out) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "edits", "n_chars", "start", "end"])

    return run


def _clean(name: str, held, rate: float, place: int):
    """Whole rows without those whose text holds an item."""

    def run(batches):
        matcher = _matcher(name, held.value, rate)
        rows: deque[pa.RecordBatch] = deque()  # of the blocks that are not verified yet

        def narrow():
            for batch in batches:
                done = 0
                for block in blocks([pa.RecordBatch.from_arrays([batch.column(place).cast(pa.string())], ["text"])]):
                    rows.append(batch.slice(done, len(block)))
                    done += len(block)
                    yield block

        for block, found in _verified(matcher, narrow()):
            keep = np.ones(len(block), dtype=bool)
            keep[[row for row, *_ in found]] = False
            yield rows.popleft().filter(pa.array(keep))

    return run


def _in_blocks(items: DataFrame, limit: int, item_id: str, item_text: str):
    """The items that hold anything, as ``(name, broadcast)`` of blocks of ``limit`` characters
    at most (or one item); the driver holds one block at a time."""
    send = items.sparkSession.sparkContext.broadcast
    rows = items.select(F.col(item_id).cast("long").alias("k"), F.col(item_text).cast("string").alias("t")).filter("t is not null").orderBy("k", "t")
    held, size = [], 0
    for key, text in rows.toLocalIterator():
        if not normal(text):
            continue
        if held and size + len(text) > limit:
            yield uuid.uuid4().hex, send(held)
            held, size = [], 0
        held.append((key, text))
        size += len(text)
    if held:
        yield uuid.uuid4().hex, send(held)


def find_leaks(
    docs: DataFrame, items: DataFrame, rate: float = 0.08, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """``doc_id, item_id, edits, n_chars, start, end``: each item that a row's text holds with at
    most ``rate`` edits a character, once, where the edits are fewest (then leftmost); ``n_chars``
    is the item's normal length, ``start`` and ``end`` code points of the text as given.

    Null and blank items, and null or empty texts, are never found. Items with equal texts are
    each found; rows that share an id are each searched. Items are bounded by blocks of
    ``block_chars``; documents are read once a block. Only the named columns are read."""
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, item_id long, edits long, n_chars long, start long, end long"
    out = None
    for name, held in _in_blocks(items, block_chars, item_id, item_text):
        part = text.mapInArrow(_search(name, held, rate), schema)
        out = part if out is None else stored(out, "leaks").union(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def without_leaks(docs: DataFrame, items: DataFrame, rate: float = 0.08, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` in which ``find_leaks`` finds no item, with all their columns."""
    for name, held in _in_blocks(items, block_chars, item_id, item_text):
        docs = docs.mapInArrow(_clean(name, held, rate, docs.columns.index(text_col)), docs.schema)
    return docs
