import hashlib
import math
import random

import numpy as np
import pytest

from linewise.llm.dualtree import Coder, Entries, _distances, _halved, assign, compress


def brute(rows, parts=4, entries=256, rounds=4):
    """(id, label, vector) rows by plain loops over whole numbers."""
    rows = [(i, lab, [math.floor(1024 * x) for x in v]) for i, lab, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    rows.sort(key=lambda r: (r[0] is None, r[0], r[2]))
    if not rows:
        return []
    d = len(rows[0][2]) // parts
    cut = lambda v, k: v[k * d : (k + 1) * d]
    books = [[cut(v, k) for _, _, v in rows[:entries]] for k in range(parts)]

    def nearest(p, book):
        return min((sum((a - b) ** 2 for a, b in zip(p, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for k in range(parts):
            own = {}
            for _, _, v in rows:
                own.setdefault(nearest(cut(v, k), books[k])[1], []).append(cut(v, k))
            books[k] = [[sum(c) // len(own[j]) for c in zip(*own[j])] if j in own else e for j, e in enumerate(books[k])]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, sums = [], {}
    for i, lab, v in rows:
        found = [nearest(cut(v, k), books[k]) for k in range(parts)]
        out.append((i, "".join(f"{j:02x}" for _, j in found), sum(x for x, _ in found), lab))
        sums[lab] = sums.get(lab, 0) + out[-1][2]
    return sorted(((i, c, e, sums[lab], sha) for i, c, e, lab in out), key=str)


def test_assignment_against_full_distances_with_ties():
    rng = np.random.default_rng(1)
    for spread in (3, 40, 3000, 1 << 26):
        for n, m in ((1, 1), (50, 7), (700, 256)):
            points = np.concatenate([rng.integers(-spread, spread, (n, 4)), np.repeat(rng.integers(-spread, spread, (1, 4)), n // 2, axis=0)])
            points = points[_halved(points, 16)]
            book = rng.integers(-spread, spread, (m, 4))
            book[m // 2] = book[0]
            got = np.full(len(points), -1)
            for start, stop, entry in assign(points, Entries(book)):
                got[start:stop] = entry
            exact = ((points[:, None, :] - book[None]) ** 2).sum(axis=2)
            assert (got == exact.argmin(axis=1)).all() and (_distances(points, book) == exact).all()


def test_whole_boxes_are_given_away():
    rng = np.random.default_rng(2)
    centres = rng.integers(-100_000, 100_000, (40, 4))
    points = (centres[:, None] + rng.integers(-50, 50, (40, 128, 4))).reshape(-1, 4)
    points = points[_halved(points, 16)]
    found = list(assign(points, Entries(centres)))
    assert sum(stop - start for start, stop, entry in found if isinstance(entry, int)) > 0.9 * len(points) and len(found) < len(points) / 16


def vectors(seed, n, d=8):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        v = [rng.gauss(rng.choice((-1, 0, 1)), 0.2) for _ in range(d)]
        kind = rng.random()
        v = None if kind < 0.02 else [*v[:-1], None] if kind < 0.04 else [float("nan"), *v[1:]] if kind < 0.06 else [*v[:-1], float("-inf")] if kind < 0.08 else [] if kind < 0.09 else [0.25] * d if kind < 0.3 else v
        out.append((rng.choice((None, i, i, i, i, i // 2)), rng.choice((None, 1, 2)), v))
    return out


@pytest.mark.parametrize("n", [0, 3, 400])
def test_rows_against_brute_force(spark, n):
    rows = vectors(n, n)
    table = spark.createDataFrame([(*r, 1, "c") for r in rows], "vec_id long, label int, embedding array<double>, id int, code string").repartition(3)
    got = sorted((tuple(r) for r in compress(table).collect()), key=str)
    assert got == brute(rows)


def test_few_entries_clipping_and_odd_lengths(spark):
    rows = [(k, "a", [math.sin(k * j) for j in range(8)]) for k in range(60)]
    table = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    assert sorted(map(tuple, compress(table, entries=5, rounds=2).collect()), key=str) == brute(rows, entries=5, rounds=2)
    odd = spark.createDataFrame([(1, "x", [1.0, 2.0, 3.0]), (2, "x", [1e300, 0.0, -1e300]), (3, "x", [1.0])], "vec_id long, label string, embedding array<double>")
    got = sorted(compress(odd, entries=1, rounds=0).collect())
    limit = Coder(odd).limit
    assert [r.vec_id for r in got] == [1, 2] and got[0].error == 0
    assert got[1].error == (limit - 1024) ** 2 + 2048**2 + (limit + 3072) ** 2 and got[1].label_error == got[1].error
