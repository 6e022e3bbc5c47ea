import random

import numpy as np
import pytest

from linewise.llm.decontaminate import Matcher, find_leaks, normal, places


def least_edits(item, text):
    """Distance of an item to the nearest part of a text, by the full matrix."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def edited(rng, text, n):
    for _ in range(n):
        k = rng.randrange(len(text))
        text = text[:k] + rng.choice(["", "q", "ß", text[k] + "x"]) + text[k + rng.randint(0, 1) :]
    return text


def make(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 7)))
    items = [" ".join(word() for _ in range(rng.choice((2, 5, 15, 30, 60)))) for _ in range(30)]
    texts = []
    for _ in range(120):
        parts = [word() for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            parts.insert(rng.randint(0, len(parts)), edited(rng, rng.choice(items), rng.randint(0, 24)).upper())
        texts.append(rng.choice((" ", "\n \t")).join(parts))
    return items, texts


@pytest.mark.parametrize("block_chars", [10**6, 800])
def test_against_the_full_matrix(spark, block_chars):
    items, texts = make(3)
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in enumerate(texts)], "doc_id long, text string, k long, t string")
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in find_leaks(docs, bench, 0.1, block_chars=block_chars).collect()}
    want = {}
    for i, text in enumerate(texts):
        for k, item in enumerate(items):
            edits = least_edits(normal(item), normal(text))
            if edits <= int(len(normal(item)) * 0.1):
                want[i, k] = edits
    assert {k: r.edits for k, r in got.items()} == want
    for (i, k), r in got.items():
        assert least_edits(normal(items[k]), f" {normal(texts[i][r.start : r.end])} ") == r.edits


def test_nulls_blanks_and_repeats(spark):
    schema = "doc_id long, text string"
    bench = spark.createDataFrame([(1, "one two three"), (1, "one two three"), (2, None), (3, " \n"), (None, "four five six")], "item_id long, text string")
    assert find_leaks(spark.createDataFrame([], schema), bench).count() == 0
    docs = spark.createDataFrame([(None, "x ONE\n two three y"), (4, None), (5, ""), (6, "four five six"), (6, "four five six")], schema)
    assert find_leaks(docs, bench.limit(0)).count() == 0
    got = sorted(((r.doc_id or 0, r.item_id or 0, r.edits, r.start, r.end) for r in find_leaks(docs, bench).collect()))
    assert got == [(0, 1, 0, 2, 16), (0, 1, 0, 2, 16), (6, 0, 0, 0, 13), (6, 0, 0, 0, 13)]


def test_places_of_wide_characters():
    text = "  İA \n\n b😀 "
    plain = normal(text)
    assert plain == "ia b😀" and len(places(text)) == len(plain) + 1
    assert [text[p] for p in places(text)[:-1]][:2] == ["İ", "A"]


def test_very_long_text():
    matcher = Matcher([(1, "needle in a hay stack")], 0.1)
    text = "a " * 200_000 + "needlein a hay stack"
    (k, a, b), *_ = [c for c in matcher.candidates(text)]
    found = [f for f in matcher.verify([(k, text[a:b]) for k, a, b in matcher.candidates(text)]) if f]
    assert found and min(found)[0] == 1
    assert np.array(found).shape[1] == 3
