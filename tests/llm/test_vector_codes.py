import hashlib
import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from epispark.llm import op11_vector_codes as V

SCHEMA = "vec_id long, embedding array<double>, label string, code int, error string, vec int, n int, no_label int"


def plain(rows, parts=16, entries=64, rounds=2, scale=256):
    """The same by loops over Python integers."""
    ok = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(ok, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = next((len(v) for _, v, _ in order if v and len(v) % parts == 0), -1)
    even = [[math.floor(Fraction(x) * scale) for x in v] for _, v, _ in order if len(v) == width]
    d = width // parts
    cut = [[v[p * d:(p + 1) * d] for p in range(parts)] for v in even]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)] if cut else []

    def near(book, q):
        return min((sum((a - b) ** 2 for a, b in zip(q, e)), k) for k, e in enumerate(book))
    for _ in range(rounds if cut else 0):
        for p in range(parts):
            taken = defaultdict(list)
            for c in cut:
                taken[near(books[p], c[p])[1]].append(c[p])
            books[p] = [[sum(x) // len(taken[k]) for x in zip(*taken[k])] if taken[k] else e for k, e in enumerate(books[p])]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded, total = [], defaultdict(lambda: None)
    for i, v, lab in ok:
        code = error = None
        if len(v) == width:
            v = [math.floor(Fraction(x) * scale) for x in v]
            hits = [near(books[p], v[p * d:(p + 1) * d]) for p in range(parts)]
            code, error = "".join(f"{k:02x}" for _, k in hits), min(sum(s for s, _ in hits), 2**63 - 1)
            total[lab] = (total[lab] or 0) + error
        coded.append((i, code, error, lab))
    return Counter((i, c, e, total[lab] and min(total[lab], 2**63 - 1), sha) if total[lab] is not None else (i, c, e, None, sha)
                   for i, c, e, lab in coded)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, 1, "x", 2, 3, 4) for i, v, lab in rows], SCHEMA).repartition(3)


def check(spark, rows, **params):
    got = Counter(tuple(r) for r in V.compress(frame(spark, rows), **params).collect())
    assert got == plain(rows, **params)


def vectors(rng, n, width=32, spread=1.0):
    return [(i * 2, [round(rng.gauss(0, spread), 3) for _ in range(width)], rng.choice(["a", "b", None])) for i in range(n)]


def test_equals_plain_rounds(spark):
    rng = random.Random(3)
    rows = vectors(rng, 300)
    rows += [(1001, None, "a"), (1002, [float("nan")] * 32, "a"), (1003, [None] + [0.0] * 31, "b"), (1004, [float("inf")] + [0.0] * 31, "b"),
             (1005, [0.0] * 16, "a"), (1006, [0.5] * 31, "only"), (1007, [], "a"), (None, [0.25] * 32, None), (None, None, None),
             (rows[7][0], rows[7][1], "a"), (rows[7][0], rows[7][1], "a")]
    rng.shuffle(rows)
    check(spark, rows)


def test_ties_and_equal_entries(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.0, 1 / 256, 2 / 256, -1 / 256]) for _ in range(16)], "t") for i in range(250)]
    check(spark, rows)


def test_wide_numbers_are_exact(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([1, -1]) * 10.0 ** rng.choice([0, 3, 9, 30, 300]) * rng.random() for _ in range(16)], "w") for i in range(90)]
    check(spark, rows, entries=20)
    rows = [(i, [1e6 * rng.random() for _ in range(32)], "w") for i in range(90)]
    check(spark, rows, entries=20)


@pytest.mark.parametrize("rows", [[], [(1, None, "a")], [(1, [1.0] * 5, None)], [(9, [1.0] * 16, None)]])
def test_few_rows(spark, rows):
    check(spark, rows)


def test_gnat_prunes_and_agrees():
    rng = np.random.default_rng(1)
    points = rng.integers(-500, 500, (200, 3))
    q = rng.integers(-600, 600, (2000, 3))
    seen = []
    tree = V.Gnat(points)
    real, V.squared = V.squared, lambda a, b: (seen.append(len(a)), real(a, b))[1]
    try:
        index, best = tree.nearest(q)
    finally:
        V.squared = real
    d2 = ((q[:, None] - points[None]) ** 2).sum(axis=2)
    assert (index == d2.argmin(axis=1)).all() and (best == d2.min(axis=1)).all()
    assert sum(seen) < 0.6 * d2.size
