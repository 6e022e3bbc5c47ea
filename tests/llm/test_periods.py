import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from linewise.llm.periods import digests, lyndon_lengths, periodic_runs, planted, runs_of


def brute_runs(words, least, times):
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, times * q):
                if not any(all(words[k] == words[k + d] for k in range(i, i + length - d)) for d in range(1, q)):
                    out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words, 24, 3)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


@pytest.mark.parametrize("letters", [1, 2, 3, 9])
def test_lyndon_lengths_and_runs_against_brute_force(letters):
    rng = random.Random(letters)
    for _ in range(150):
        s = [rng.randrange(letters) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.5 and s:
            s = (s[: rng.randint(1, 9)] * 12)[:40] + s[:5]
        nearest = [next((j for j in range(i + 1, len(s)) if s[j:] < s[i:]), len(s)) - i for i in range(len(s))]
        assert lyndon_lengths(s) == nearest
        for least, times in ((2, 2), (6, 3), (8, 2)):
            assert runs_of(np.array(s, np.int64), least, times) == brute_runs(s, least, times)


def fixture(seed):
    rng = random.Random(seed)
    texts = [None, "", " \n", "a", "é " * 30, "a b " * 12, "a b " * 11 + "a", "x " * 23, "x " * 24]
    for _ in range(250):
        words = [f"w{rng.randrange(rng.choice((2, 5, 400)))}" for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 3)):
            at, unit = rng.randint(0, len(words)), [f"u{rng.randrange(4)}" for _ in range(rng.randint(1, 12))]
            words[at:at] = (unit * 9)[: rng.randint(10, 60)]
        texts.append(rng.choice((" ", "\n", "\x0b \t")).join(words))
    return list(enumerate(texts, -3))


def test_query_rows_against_brute_force(spark):
    rows = fixture(5)
    docs = spark.createDataFrame([(i, t, i, "x") for i, t in rows], "doc_id long, text string, n_words long, runs string").repartition(5)
    got = {tuple(r) for r in digests(periodic_runs(planted(docs))).collect()}
    assert got == {brute_row(i, t) for i, t in rows}
    assert any(r[1] > 1 for r in got) and any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows)


def test_repeated_rows_missing_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([(7, "b " * 30), (7, "b " * 30), (None, "c d " * 20)], "doc_id long, text string")
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(planted(docs)).collect()), key=str)
    assert got == [(7, [(0, 30, 1)], "b"), (7, [(0, 30, 1)], "b"), (None, [(0, 40, 2)], "c d")]
    assert digests(periodic_runs(planted(docs.limit(0)))).count() == 0


def test_very_long_texts_and_other_bounds(spark):
    unit = " ".join(f"v{k}" for k in range(300))
    texts = ["y " * 300_000, (unit + " ") * 200 + "end", " ".join(str(k) for k in range(100_000))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic_runs(docs).collect()}
    assert got == {0: [(0, 300_000, 1)], 1: [(0, 60_000, 300)], 2: []}
    few = spark.createDataFrame([(1, "a b a b c"), (2, "a a")], "doc_id long, text string")
    assert {r.doc_id: [tuple(x) for x in r.runs] for r in periodic_runs(few, least=2, times=2).collect()} == {1: [(0, 4, 2)], 2: [(0, 2, 1)]}
