import random
import re
from collections import Counter

import numpy as np
import pytest

from linewise.llm.boosting import train
from linewise.llm.quality import BASE, fit, judge, keep_good


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    times = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {k for i in range(len(words) - 4) if times[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed)


def make(seed, n=200):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghé#|<> A") for _ in range(rng.randint(1, 5)))
    lines = [" ".join(word() for _ in range(rng.randint(0, 9))) for _ in range(40)]
    texts = [rng.choice(("\n", "\n\n", " \r\n"))
             .join(rng.choice(lines) if rng.random() < 0.4 else " ".join(word() for _ in range(6)) for _ in range(rng.randint(0, 14))) for _ in range(n)]
    return texts + [None, "", "\n", "\n\n", " ", "a", "a\na\n", "\na", "x y z w v x y z w v", "a b a b a b a b a b a b"]


def test_base_counts_against_brute_force(spark):
    texts = make(1)
    docs = spark.createDataFrame([(i, t, 1, "q") for i, t in enumerate(texts)], "doc_id long, text string, id long, good string")
    forest = train(np.zeros((0, 12)), np.zeros(0))
    got = {r.doc_id: tuple(r[b] for b in BASE) + (r.base_failed,) for r in judge(docs, forest).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_monotonic_and_accurate():
    rng = np.random.default_rng(4)
    x = rng.random((3000, 4))
    y = ((x[:, 0] + 0.3 * np.sin(12 * x[:, 1]) + 0.1 * rng.standard_normal(3000)) > 0.6).astype(float)
    forest = train(x[:2000], y[:2000], rising=(0,))
    assert ((forest.score(x[2000:]) > 0.5) == y[2000:]).mean() > 0.85
    for _ in range(50):
        line = np.repeat(rng.random((1, 4)), 200, axis=0)
        line[:, 0] = np.linspace(0, 1, 200)
        assert (np.diff(forest.score(line)) >= -1e-12).all()


@pytest.mark.parametrize("y", [[], [1.0], [0.0, 0.0]])
def test_training_without_both_classes(y):
    forest = train(np.zeros((len(y), 3)), np.array(y))
    assert np.allclose(forest.score(np.ones((2, 3))), (sum(y) + 1) / (len(y) + 2))


def test_held_out_labels(spark):
    data = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    train_on, rest = labels.filter("doc_id % 4 <> 0"), labels.filter("doc_id % 4 = 0")
    got = judge(docs, fit(docs, train_on)).join(rest, "doc_id").select("kept", "base_failed", "quality").collect()
    good = [r for r in got if r.quality == 1 and not r.base_failed]
    bad = [r for r in got if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.97 * len(good)
    assert sum(not r.kept for r in bad) >= 0.8 * len(bad)


def test_empty_tables_and_kept_rows(spark):
    docs = spark.createDataFrame([(1, "w%d " % 1 * 3, 2), (2, " ".join(f"w{k}" for k in range(30)), 3), (None, None, 4)], "doc_id long, text string, id long")
    none = spark.createDataFrame([], "doc_id long, quality int")
    forest = fit(docs, none)
    assert len(forest.roots) == 0
    assert [tuple(r)[::2] for r in keep_good(docs, forest).collect()] == [(2, 3)]
    assert judge(docs.limit(0), forest).count() == 0 and keep_good(docs.limit(0), forest).count() == 0


def thue_morse(n, one, other):
    word = [0]
    while len(word) < n:
        word += [1 - x for x in word]
    return "".join(one if x else other for x in word[:n])


def test_words_and_lines_that_collide_in_sums_of_powers(spark):
    a, b = thue_morse(4096, "a", "b"), thue_morse(4096, "b", "a")
    texts = [f"{a}\n{b}\n{a}x", f"p q r s {a} m n o u v p q r s {b} x1 x2 x3", f"{a} {a} {a} {a} {a} {a} {b}", "é" * 5000 + "\n" + "é" * 4999 + "\n" + "é" * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r[c] for c in BASE) + (r.base_failed,) for r in judge(docs, train(np.zeros((0, 12)), np.zeros(0))).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}
