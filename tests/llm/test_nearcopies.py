import random
import re

import pytest

from linewise.llm.components import components, with_links
from linewise.llm.nearcopies import near_copies


def brute(texts, width, num, den):
    sets = []
    for t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else ({tuple(words)} if words else set()))
    top = list(range(len(texts)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                x, y = sorted((find(i), find(j)))
                top[y] = x
    return [(i, len(s), find(i), find(i) == i) for i, s in enumerate(sets)]


def make(seed, families, copies):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4))) for _ in range(300)]
    texts = [None, "", "  \n", "One", "one", "one two", "ONE\ttwo", "x y z", "É y z", "é y z"]
    for _ in range(families):
        base = [rng.choice(words) for _ in range(rng.choice((8, 40, 150)))]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(rng.choice((" ", "\n")).join(own))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("width,num,den,seed", [(3, 85, 100, 1), (5, 80, 100, 2)])
def test_against_brute_force(spark, width, num, den, seed, monkeypatch):
    import linewise.llm.nearcopies as module

    monkeypatch.setattr(module, "BUCKET_BLOCK", 8)
    texts = make(seed, 25, 24)
    docs = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(texts)], "doc_id long, text string, sig string, id long")
    got = near_copies(docs, width, num, den).collect()
    want = brute(texts, width, num, den)
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == want


def test_empty_null_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert near_copies(spark.createDataFrame([], schema), 3, 85, 100).count() == 0
    docs = spark.createDataFrame([(None, "a b c"), (5, "a b c"), (5, "a b c"), (2, "a B c"), (3, None)], schema)
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in near_copies(docs, 3, 85, 100).collect())
    assert got == [(0, 1, 0, True), (2, 1, 2, True), (3, 0, 3, True), (5, 1, 2, False), (5, 1, 2, False)]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, k) for k in range(200, 230)] + [(500, 500)]
    want = {**{k: 100 for k in range(100, 141)}, 7: 7, **{k: 7 for k in range(200, 230)}}
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == want
    more = with_links(found, spark.createDataFrame([(140, 229), (900, 901), (901, 902)], "a long, b long"))
    assert {r.node: r.component for r in more.collect()} == {**{k: 7 for k in want}, 900: 900, 901: 900, 902: 900}
    assert {r.node: r.component for r in with_links(found, spark.createDataFrame([], "a long, b long")).collect()} == want


def test_words_that_collide_in_sums_of_powers(spark):
    word = [0]
    while len(word) < 4096:
        word += [1 - x for x in word]
    a, b = "".join("ab"[x] for x in word), "".join("ba"[x] for x in word)
    docs = spark.createDataFrame([(1, a), (2, b), (3, f"u v {a}"), (4, f"u v {b}"), (5, a.upper())], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_copies(docs, width=3, num=85, den=100).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}


def test_a_large_component_that_shares_buckets_with_strangers(spark):
    """One group of near-copies over many blocks, and small ones that are almost like it."""
    rng = random.Random(4)
    base = [f"w{k}" for k in range(60)]
    texts = []
    for k in range(700):
        words = list(base)
        words[rng.randrange(60)] = f"x{k}"
        texts.append(" ".join(words))
    for k in range(12):
        words = list(base)
        for at in rng.sample(range(60), 4 + k % 5):
            words[at] = f"y{k}-{at}"
        texts += [" ".join(words), " ".join([*words[:-1], f"z{k}"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_copies(docs, width=2, num=85, den=100).collect()}
    assert got == {i: (n, c) for i, n, c, _ in brute(texts, 2, 85, 100)} and len({c for _, c in got.values()}) > 3
