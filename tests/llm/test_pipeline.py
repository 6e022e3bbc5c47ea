"""The pipeline against a version in plain Python, on a small set of tables."""

from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from linewise.llm import quality
from linewise.llm.decontaminate import normal
from linewise.llm.wordids import default_tokenizer
from tests.llm.test_decontaminate import least_edits
from tests.llm.test_nearcopies import brute as near_brute
from tests.llm.test_quality import brute as quality_brute
from tests.llm.test_secrets import base

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Short documents of the smallest tables, with leaks, copies and secrets of our own."""
    path = str(tmp_path_factory.mktemp("tables"))
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").filter("length(text) < 900").collect()]
    items = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").limit(6).collect()]
    fine = {r.doc_id for r in spark.read.parquet(f"{DATA}/labels.parquet").filter("quality = 1").collect()}
    long = [d for d in docs if len(d[1].split()) > 60 and d[0] in fine] * 20
    extra = [(1000 + k, f"{long[k][1]} {items[k].upper()} {long[k + 1][1]}", "en", f"src{k}", 0) for k in range(4)]
    extra += [(1100 + k, long[k][1] + " more", "en", "src1", 0) for k in range(3)]
    extra += [(1200 + k, f"{long[k][1]} {long[k + 2][1]} password=0f1e2d3c4b5a697887{k}6 and 99887766554433221100", "en", f"src{k}", 0) for k in range(4)]
    extra += [(None, long[12][1], None, None, None), (2000, None, "en", "src0", 0), (2001, "", "en", "src0", 0)]
    spark.createDataFrame(docs + extra, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.read.parquet(f"{DATA}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return path


def masked(rows):
    owners = {}
    for _, text, _, source, _ in rows:
        for s in base(text or ""):
            owners.setdefault(s[4], set()).add(source or "")
    out = []
    for key, text, *rest in rows:
        spans = [(a, b) for a, _, b, _, v in base(text or "") if len(owners[v]) < 3]
        merged = []
        for a, b in spans:
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        for a, b in reversed(merged):
            text = text[:a] + "[SECRET]" + text[b:]
        out.append((key, text, *rest))
    return out


def test_stages_against_plain_python(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    forest = quality.fit(docs, spark.read.parquet(f"{tables}/labels.parquet"))
    bad = {(r.doc_id, r.n_words, r.word_chars): r.bad for r in quality.judge(docs, forest).collect()}
    good = [r for r in rows if not (s := quality_brute(r[1]))[-1] and bad[r[0], s[0], s[1]] <= 0.7]

    named = sorted((r for r in good if r[0] is not None), key=lambda r: r[0])
    first = [named[i] for i, _, component, kept in near_brute([r[1] for r in named], 5, 80, 100) if kept]
    first += [r for r in good if r[0] is None]

    items = [normal(r.text) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]

    def leaks(text):
        plain = normal(text)
        return any(item in plain or (len(plain) < 1500 and least_edits(item, plain) <= int(len(item) * 0.08)) for item in items)

    clean = [r for r in first if not leaks(r[1])]
    want = [(k, t, lang, source, len(t)) for k, t, lang, source, _ in masked(clean)]

    stages = dict(corpus_pipeline.STAGES)
    current = docs
    for name, expected in (("quality rules", good), ("near-duplicates", first), ("benchmark decontamination", clean), ("secret scans", want)):
        current = stages[name](spark, current, tables)
        assert current.columns == docs.columns
        assert Counter(tuple(r) for r in current.collect()) == Counter(expected), name
    assert len(rows) > len(good) > len(first) > len(clean) and any("[SECRET]" in r[1] for r in want) and any("99887766554433221100" in r[1] for r in want)

    tokenizer = Tokenizer.from_file(default_tokenizer())
    pieces = Counter()
    for key, text, *_ in want:
        n = len(tokenizer.encode(text, add_special_tokens=False).ids) + 1
        for piece, at in enumerate(range(0, n, 2048)):
            pieces[key, piece, at, min(2048, n - at)] += 1
    packed = corpus_pipeline.run(spark, tables).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length) for r in packed) == pieces
    used = Counter()
    for r in packed:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048 and len(used) <= np.ceil(sum(used.values()) / 2048) + 1
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near-duplicates", "benchmark decontamination", "secret scans", "best-fit packing"]


def test_empty_documents(spark, tables):
    current = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        current = stage(spark, current, tables)
        assert current.count() == 0
