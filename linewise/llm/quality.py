"""Quality rules: fixed base limits, then gradient-boosted trees over document statistics.

All statistics of a block of texts are computed at once, over the bytes of all its texts.
The trees learn from a sample of labelled documents of at most ``SAMPLE_ROWS`` rows, drawn by
a hash of the id; whatever the corpus holds, every document is then scored in full.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linewise.llm.blocks import _ODD, _SPACE, Block, blocks, byte_hashes, mix, shingle_hashes, word_bounds, word_hashes
from linewise.llm.boosting import Forest, train

SAMPLE_ROWS = 20_000
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 5


def _marks(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_SYMBOL = _marks(b"#*$%&|<>")
_UPPER, _DIGIT = _marks(bytes(range(65, 91))), _marks(bytes(range(48, 58)))
_LOUD, _STOP = _marks(b"!?"), _marks(b".,;:")
FEATURES = (
    "symbols_per_char", "repeat_words", "dup_lines", "loud_per_char", "upper_share", "digit_share", "stops_per_word",
    "chars_per_word", "distinct_words", "log_words", "words_per_line", "most_common_byte",
)
#: The probability of bad quality never falls as one of these grows.
RISING = tuple(FEATURES.index(f) for f in ("symbols_per_char", "repeat_words", "dup_lines", "loud_per_char"))


def statistics(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Of each text the base counts (columns of ``BASE``) and the features."""
    data, offs, n = block.data, block.offs, len(block)
    starts, ends, first = word_bounds(data, offs)
    words = word_hashes(data, starts, ends, fold=False)
    n_words = np.diff(first)
    text_of_word = np.repeat(np.arange(n), n_words)

    def per_text(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask)])
        return sums[offs[1:]] - sums[offs[:-1]]

    in_word = ~_SPACE[data]
    word_chars = per_text(in_word & ((data & 0xC0) != 0x80))
    symbols = per_text(_SYMBOL[data])

    # Lines: a text's pieces between line ends. Those with a word count, once for each different one.
    breaks = np.flatnonzero(data == 10)
    line_start = np.sort(np.concatenate([offs[:-1], breaks + 1]), kind="stable")
    text_of_line = np.repeat(np.arange(n), per_text(data == 10) + 1)
    line_end = np.minimum(np.concatenate([line_start[1:] - 1, [len(data)]]), offs[1:][text_of_line]) if n else line_start
    last_line = np.concatenate([text_of_line[1:] != text_of_line[:-1], [True]]) if n else np.zeros(0, bool)
    line_end[last_line] = offs[1:][text_of_line[last_line]]
    worded = np.concatenate([[0], np.cumsum(in_word)])
    has_word = worded[line_end] > worded[line_start]
    own = text_of_line[has_word]
    line_hash = byte_hashes(data, line_start[has_word], line_end[has_word])
    distinct = np.unique(mix(line_hash + own.astype(np.uint64) * _ODD), return_index=True)[1]
    n_lines = np.bincount(own, minlength=n)
    dup_lines = n_lines - np.bincount(own[distinct], minlength=n)

    # Words in windows of five that occur again in the text.
    repeat = np.zeros(n, np.int64)
    if len(words) >= WINDOW:
        grams = shingle_hashes(words, WINDOW)
        inside = np.flatnonzero(text_of_word[: len(grams)] == text_of_word[WINDOW - 1 :])
        _, which, times = np.unique(mix(grams[inside] + text_of_word[inside].astype(np.uint64) * _ODD), return_inverse=True, return_counts=True)
        at = inside[times[which] > 1]
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + WINDOW, -1)
        repeat = np.bincount(text_of_word[np.cumsum(edge[:-1]) > 0], minlength=n)
    kinds = np.unique(mix(words + text_of_word.astype(np.uint64) * _ODD), return_index=True)[1]
    n_kinds = np.bincount(text_of_word[kinds], minlength=n)

    base = np.stack([n_words, word_chars, symbols, dup_lines, repeat], axis=1).astype(np.int64)
    chars, some_words = np.maximum(word_chars, 1), np.maximum(n_words, 1)
    common = np.array([np.bincount(data[a:b][in_word[a:b]]).max(initial=0) for a, b in zip(offs[:-1], offs[1:])], np.int64)
    features = np.stack([
        symbols / chars, repeat / some_words, dup_lines / np.maximum(n_lines, 1), per_text(_LOUD[data]) / chars, per_text(_UPPER[data]) / chars,
        per_text(_DIGIT[data]) / chars, per_text(_STOP[data]) / some_words, word_chars / some_words, n_kinds / some_words, np.log1p(n_words),
        n_words / np.maximum(n_lines, 1), common / chars,
    ], axis=1)
    return base, features


def base_failed(base: np.ndarray) -> np.ndarray:
    """Fewer than ten words, or over a fifth of the words in repeated windows."""
    return (base[:, 0] < 10) | (100 * base[:, 4] > 20 * base[:, 0])


def _text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", good: str = "quality", rows: int = SAMPLE_ROWS, **options) -> Forest:
    """Trees that give the probability that a document's quality label is 0. They learn from
    at most ``rows`` labelled documents: those whose ids hash least. Labels without a document,
    and null labels, are left out; no label at all gives a forest without trees."""
    wanted = labels.select(F.col(label_id).cast("long").alias("id"), F.col(good).cast("int").alias("good"))
    wanted = wanted.filter("id is not null and good is not null").groupBy("id").agg(F.min("good").alias("good"))
    wanted = wanted.orderBy(F.xxhash64("id"), "id").limit(rows)

    def run(batches):
        for block in blocks(batches):
            _, features = statistics(block)
            flat = pa.array(features.ravel())
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), block.column("good"), pa.ListArray.from_arrays(pa.array(np.arange(len(block) + 1) * features.shape[1], pa.int32()), flat)], ["id", "good", "x"]
            )

    found = _text(docs, id_col, text_col).join(F.broadcast(wanted), "id")  # of at most `rows` rows
    known = found.select("id", "good", "text").mapInArrow(run, "id long, good int, x array<double>").groupBy("id").agg(F.min("good").alias("good"), F.min("x").alias("x"))
    known = sorted(known.collect(), key=lambda r: r.id)
    x = np.array([r.x for r in known], float).reshape(len(known), len(FEATURES))
    return train(x, np.array([float(r.good == 0) for r in known]), rising=RISING, **options)


def judge(docs: DataFrame, forest: Forest, limit: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``bad`` (probability) and ``kept`` of every row.

    A row is kept unless the base limits fail or ``bad`` exceeds ``limit``. A null or empty text
    has no words and fails. Rows that share an id, or have none, are each judged; only the two
    named columns are read."""

    def run(batches):
        for block in blocks(batches):
            base, features = statistics(block)
            failed, bad = base_failed(base), forest.score(features)
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), *(pa.array(base[:, k]) for k in range(len(BASE))), pa.array(failed), pa.array(bad), pa.array(~failed & (bad <= limit))],
                ["doc_id", *BASE, "base_failed", "bad", "kept"],
            )

    longs = ", ".join(f"{name} long" for name in BASE)
    return _text(docs, id_col, text_col).mapInArrow(run, f"doc_id long, {longs}, base_failed boolean, bad double, kept boolean")


def keep_good(docs: DataFrame, forest: Forest, limit: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge`` would keep, with all their columns."""
    place = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            narrow = pa.RecordBatch.from_arrays([batch.column(place).cast(pa.string())], ["text"])
            keep = []
            for block in blocks([narrow]):
                base, features = statistics(block)
                keep.append(~base_failed(base) & (forest.score(features) <= limit))
            if keep:
                yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(run, docs.schema)
