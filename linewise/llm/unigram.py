"""Token counts of a unigram vocabulary by a Viterbi pass that keeps only scores and counts.

The vocabulary's pieces are found in a text by an Aho-Corasick automaton, which names, at
each end, the longest piece (the earliest start) first. Ties follow the tokenizers library's
unigram model: of paths with equal scores into a place the one whose last piece starts
first stays. A character that no piece of one character covers costs the least score less
ten; unknown ones in a row count as their UTF-8 bytes (byte fallback), or as one without it. White space is the library's Metaspace:
a blank starts a new word, and a word mark is put before a text that has none.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewise.llm.blocks import blocks

MARK = "▁"
UNKNOWN_PENALTY = 10.0  # fixed value of the library
CACHE_SEGMENTS = 300_000


def vocabulary(model: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, by id."""
    import sentencepiece

    held = sentencepiece.SentencePieceProcessor(model_file=model)
    return [(held.id_to_piece(i), held.get_score(i)) for i in range(held.get_piece_size())]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class UnigramCounter:
    """``count(text)``: number of pieces and best score. Segments are counted once and kept,
    up to a fixed number; of two sets the older goes when the newer is full."""

    def __init__(self, pieces: list[tuple[str, float]], unknown_id: int = 0):
        import ahocorasick

        self.literal = pieces[unknown_id][0]
        self.automaton = ahocorasick.Automaton()
        for k, (piece, score) in enumerate(pieces):
            if piece:
                self.automaton.add_word(piece, (len(piece), score, k == unknown_id))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        names = {piece for piece, _ in pieces}
        self.fallback = all(f"<0x{b:02X}>" in names for b in range(256))
        # Where no piece holds a line end, line ends cut a text into segments, as word marks do.
        self.lines_cut = self.fallback and not any("\n" in piece for piece in names)
        self.kept: dict[str, complex] = {}
        self.older: dict[str, complex] = {}

    def _worth(self, unknown: int, alone: bool) -> int:
        """Pieces of a run of unknown characters of so many bytes; ``alone``: it is the unknown
        piece as written."""
        return unknown if unknown and self.fallback and not alone else int(unknown > 0)

    def _best(self, segment: str) -> complex:
        """Of each place: best score, pieces before the run of unknown characters that ends
        there, and that run's bytes."""
        n = len(segment)
        score, count, open_, alone = [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        ends: list[list[tuple[int, float, bool]]] = [[] for _ in range(n)]
        for end, match in self.automaton.iter(segment):
            ends[end].append(match)
        for end in range(n):
            best = None
            single = False
            for length, own, unknown in ends[end]:
                start = end + 1 - length
                single = single or length == 1
                if best is None or score[start] + own > best:
                    best, source, is_unknown = score[start] + own, start, unknown
            if not single and (best is None or score[end] + self.unknown > best):
                best, source, is_unknown = score[end] + self.unknown, end, True
            to = end + 1
            score[to] = best
            if is_unknown:
                count[to], open_[to] = count[source], open_[source] + len(segment[source:to].encode())
                alone[to] = not open_[source] and segment[source:to] == self.literal
            else:
                count[to] = count[source] + self._worth(open_[source], alone[source]) + 1
        return complex(count[n] + self._worth(open_[n], alone[n]), score[n])

    def _of(self, segment: str) -> complex:
        found = self.older.get(segment)
        if found is None:
            found = self._best(segment)
        if len(self.kept) >= CACHE_SEGMENTS // 2:
            self.kept, self.older = {}, self.kept
        self.kept[segment] = found
        return found

    def count(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        text = text.replace(" ", MARK)
        text = text if text.startswith(MARK) else MARK + text
        text = text.replace(MARK, " " + MARK)
        if self.lines_cut and self.literal not in text:
            text = text.replace("\n", " \n ")
        kept, total = self.kept.get, 0j
        for segment in text.split(" "):
            if segment:
                total += kept(segment) or self._of(segment)
        return int(total.real), total.imag


_counters: dict[str, UnigramCounter] = {}


def counter(model: str) -> UnigramCounter:
    if model not in _counters:
        _counters[model] = UnigramCounter(vocabulary(model))
    return _counters[model]


def count_tokens(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, score`` of every row; a null or empty text has 0 tokens and score 0.
    Rows that share an id, or have none, are each counted; only the two named columns are read."""

    def run(batches):
        own = counter(model)
        for block in blocks(batches):
            found = [own.count(text.decode()) for text in block.texts()]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())],
                ["doc_id", "n_tokens", "score"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, score double")
