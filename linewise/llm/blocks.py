"""Arrow batches of texts cut into blocks of bounded bytes, and words found in them with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

BLOCK_BYTES = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Block:
    """Some rows of a batch: ``data`` (uint8) holds their texts end to end, ``offs`` where
    each starts and, last, where all end; ``batch`` the rows' columns."""

    def __init__(self, batch: pa.RecordBatch, text: str):
        self.batch = batch
        column = batch.column(batch.schema.get_field_index(text)).fill_null("").cast(pa.large_binary())
        _, offs, data = column.buffers()
        offs = np.frombuffer(offs, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.data, self.offs = whole[offs[0] : offs[-1]], offs - offs[0]

    def __len__(self) -> int:
        return len(self.offs) - 1

    def texts(self) -> list[bytes]:
        raw, offs = self.data.tobytes(), self.offs.tolist()
        return [raw[a:b] for a, b in zip(offs, offs[1:])]

    def column(self, name: str) -> pa.Array:
        return self.batch.column(self.batch.schema.get_field_index(name))

    def numbers(self, name: str) -> np.ndarray:
        return self.column(name).to_numpy(zero_copy_only=False)


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Every row once, in order; a block has at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(batch.schema.get_field_index(text))).fill_null(0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start, done = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield Block(batch.slice(start, stop - start), text)
            start, done = stop, int(ends[stop - 1])
    pa.default_memory_pool().release_unused()  # a worker goes on to other tasks


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers = np.zeros(0, np.uint64)
_inverse = np.zeros(0, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of an odd base modulo 2^64, and of its inverse."""
    global _powers, _inverse
    if len(_powers) < n:
        base, size = 0xD1342543DE82EF95, max(n, BLOCK_BYTES + 1)
        _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, base, np.uint64)]), dtype=np.uint64)
        back = pow(base, -1, 1 << 64)
        _inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, back, np.uint64)]), dtype=np.uint64)
    return _powers[:n], _inverse[:n]


def word_bounds(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes outside space and 9-13, none across texts; and
    the first word of each text, with the number of words last."""
    n = len(data)
    word = ~_SPACE[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offs] = True
    starts, ends = word.copy(), word.copy()
    if n:
        starts[1:] &= ~word[:-1] | edge[1:n]
        ends[:-1] &= ~word[1:] | edge[1:n]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(starts, offs)


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of bytes, by XXH3: sums of powers modulo 2^64 are equal for
    texts that can be written down."""
    raw, n = data.tobytes(), len(starts)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, map(raw.__getitem__, map(slice, starts.tolist(), ends.tolist()))), np.uint64, n)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool) -> np.ndarray:
    """A 64-bit hash of each word, with A-Z lower-cased first where ``fold``."""
    return byte_hashes(_FOLD[data] if fold else data, starts, ends)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive words (``len(words) - width + 1`` values)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total = total * _ODD + words[k : k + n]
    return mix(total)


def whole_hash(words: np.ndarray) -> np.uint64:
    """A hash of a whole word sequence."""
    total = len(words)
    for word in words.tolist():
        total = (total * int(_ODD) + word) & 0xFFFFFFFFFFFFFFFF
    return mix(np.array([total], np.uint64))[0]
