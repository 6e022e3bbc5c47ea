import hashlib
import random
from collections import defaultdict

import pytest

from linewise.llm.suffixes import encode_run, merge_runs, read_run, remove_repeats


def brute(texts, length):
    starts = defaultdict(list)
    raw = [(t or "").encode() for t in texts]
    for k, b in enumerate(raw):
        for i in range(len(b) - length + 1):
            starts[b[i : i + length]].append((k, i))
    gone = [bytearray(len(b)) for b in raw]
    for places in starts.values():
        if len(places) > 1:
            for k, i in places:
                gone[k][i : i + length] = b"\1" * length
    out = []
    for b, g in zip(raw, gone):
        kept = bytes(x for x, m in zip(b, g) if not m)
        spans = sum(1 for i, m in enumerate(g) if m and (i == 0 or not g[i - 1]))
        out.append((len(b), sum(g), spans, hashlib.sha256(kept).hexdigest()))
    return out


def make(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé ") for _ in range(rng.randint(1, 40)))
    passages = [word() + word() for _ in range(6)]
    texts = ["".join(rng.choice([word(), rng.choice(passages)]) for _ in range(rng.randint(0, 8))) for _ in range(n)]
    texts += [texts[0], texts[0], None, "", "a" * 300, "a" * 7, "ab" * 90, passages[0] * 3]
    texts += [texts[5][:k] for k in range(0, 40, 7)] + [passages[1][k:] + "xyz" for k in range(0, 30, 5)]
    return texts


@pytest.mark.parametrize("length,seed", [(12, 1), (24, 2), (5, 3), (40, 4), (25, 5), (3, 6), (4, 7)])
def test_against_brute_force(spark, length, seed):
    texts = make(seed)
    rows = [(k, t, "x", 1) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string, blob long")
    got = remove_repeats(docs, length, digest_only=True).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == dict(enumerate(brute(texts, length)))


def test_empty_table_null_and_repeated_ids(spark):
    schema = "doc_id long, text string"
    assert remove_repeats(spark.createDataFrame([], schema), 10).count() == 0
    docs = spark.createDataFrame([(None, "abcdefghijklmnop"), (1, None), (1, "zabcdefghijkly"), (1, "zabcdefghijkly")], schema)
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed, bytes(r.kept)) for r in remove_repeats(docs, 10).collect())
    assert got == [(0, 16, 12, b"mnop"), (1, 0, 0, b""), (1, 14, 14, b""), (1, 14, 14, b"")]


def test_too_short_a_length_is_refused(spark):
    with pytest.raises(ValueError):
        remove_repeats(spark.createDataFrame([], "doc_id long, text string"), 2)


def test_merge_keeps_order_and_shared_lengths():
    rng = random.Random(9)
    for _ in range(30):
        runs, everything = [], []
        for _ in range(rng.randint(1, 9)):
            rows = sorted({(0, bytes(rng.choices(b"ab", k=rng.randint(0, 12))), b"", 7) for _ in range(rng.randint(0, 20))})
            everything += [r[1] for r in rows]
            runs.append(read_run(encode_run(rows, dict.fromkeys(rows, 1))))
        merged = list(merge_runs(runs))
        assert [row[0] for _, row, _ in merged] == sorted(everything)
        for (_, a, _), (_, b, shared) in zip(merged, merged[1:]):
            x, y = a[0], b[0]
            n = 0
            while n < min(len(x), len(y)) and x[n] == y[n]:
                n += 1
            assert shared == n
