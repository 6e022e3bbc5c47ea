"""Token ids of whole texts by the tokenizers library, each distinct chunk encoded once.

For a tokenizer that drops white space and never joins across it (such as
``word_bpe_49k.json``) a text's ids are those of its white-space-separated chunks. A worker
keeps the ids of the chunks it has seen, up to a fixed number, and asks the library for the
others, many at a time. Of two sets of kept chunks the older one goes when the newer is full.
Chunks are cut further where a word certainly ends, so that a word is kept once, whatever marks follow it.
"""

from __future__ import annotations

import os
from unicodedata import is_normalized

import numpy as np

from linewise.llm.blocks import _FOLD, Block

CACHE_CHUNKS = 400_000
_LETTER, _DIGIT, _MARK = (np.zeros(256, dtype=bool) for _ in range(3))
_LETTER[97:123] = True
_DIGIT[48:58] = True
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True


def _cuts(data: np.ndarray) -> np.ndarray:
    """Where a word certainly ends within a chunk: after a letter (a-z, or one of U+00E0 to U+00FF)
    before an ASCII digit or mark, on both sides of a digit, and after a mark before a letter. Only an
    apostrophe may start a word with the letters behind it."""
    if len(data) < 2:
        return np.zeros(0, np.int64)
    left, right = data[:-1], data[1:]
    second = (left == 0xC3) & (right >= 0xA0) & (right != 0xB7)  # of a letter of two bytes, at ``right``
    ends = _LETTER[data]
    ends[1:] |= second
    begins = _LETTER[data]
    begins[:-1] |= second
    digit, mark = _DIGIT[data], _MARK[data]
    cut = (ends[:-1] | digit[:-1]) & (digit[1:] | mark[1:]) | digit[:-1] & begins[1:] | mark[:-1] & (digit[1:] | begins[1:] & (left != 39))
    return np.flatnonzero(cut) + 1


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """``encode(block)``: for each text of a block its ids, as little-endian 32-bit bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.is_end[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = {token.content.encode()[:2] for token in added}

    def _alone(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, chunks: list[bytes]) -> None:
        for at in range(0, len(chunks), 4000):
            some = chunks[at : at + 4000]
            texts = [c.decode() for c in some]
            # Letters only, already in the normal form, are one word: its last token has the word-end mark.
            plain = [t.isalpha() and t.islower() and is_normalized("NFC", t) for t in texts]
            words = [t for t, p in zip(texts, plain) if p]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) == len(words):
                raw, ends = ids.tobytes(), (ends * 4).tolist()
                self.cache.update(zip((t.encode() for t in words), map(raw.__getitem__, map(slice, [0, *ends], ends))))
            else:
                plain = [False] * len(some)
            rest = [(c, t) for c, t, p in zip(some, texts, plain) if not p]
            coded = self.tokenizer.encode_batch_fast([t for _, t in rest], add_special_tokens=False)
            self.cache.update((c, np.array(e.ids, "<u4").tobytes()) for (c, _), e in zip(rest, coded))

    def encode(self, block: Block) -> list[bytes]:
        data, offs = _FOLD[block.data], block.offs
        stop = _cuts(data)
        raw = np.insert(data, stop, 32).tobytes()
        cut = (offs + np.searchsorted(stop, offs)).tolist()
        whole = block.data.tobytes()
        words: list[list[bytes] | bytes] = []
        needed: set[bytes] = set()
        for k, (a, b) in enumerate(zip(cut, cut[1:])):
            text = whole[offs[k] : offs[k + 1]]
            if any(s in text for s in self.special):  # may hold an added token, which is found in the text as written
                words.append(self._alone(text))
                continue
            chunks = raw[a:b].split()
            needed.update(chunks)
            words.append(chunks)
        missing = needed.difference(self.cache)
        known = [c for c in missing if c in self.older] if self.older else []
        self.cache.update((c, self.older[c]) for c in known)
        if missing := list(missing.difference(known)):
            self._learn(missing)
        out = [w if isinstance(w, bytes) else b"".join(map(self.cache.__getitem__, w)) for w in words]
        if len(self.cache) > CACHE_CHUNKS // 2:
            self.cache, self.older = {}, self.cache
        return out


_known: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One encoder for a worker's life."""
    if path not in _known:
        _known[path] = WordIds(path)
    return _known[path]
