import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from epispark.llm import op13_divergence as D
from helpers_llm import empty_docs, odd_docs

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_docs=10, top=10):
    """rows: (lang, source, text)"""
    rows = [tuple(x or "" for x in r) for r in rows]
    counts, df, lang_n = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        words = TERM.findall(text.translate(LOW))
        counts[lang, source].update(words)
        df[lang].update(set(words))
        lang_n[lang].update(words)
    out = []
    for lang in {r[0] for r in rows}:
        kept = sorted(t for t, n in df[lang].items() if n >= min_docs)
        v = len(kept)

        def shares(count):
            total = sum(count[t] for t in kept)
            return [1 + 1_000_000_000 * (count[t] + 2) // (total + 2 * v) for t in kept]
        sources = sorted(s for a, s in counts if a == lang)
        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(lang_n[lang])

        def f(a, b):
            return (a - b) ** 2 // (a + b)
        for s in sources:
            pair = [(-sum(map(f, p[s], p[o])), o) for o in sources if o != s]
            term = [(-f(a, b), t) for t, a, b in zip(kept, p[s], q) if counts[lang, s][t] and a > b]
            for part, items in (("pair", sorted(pair)), ("term", sorted(term)[:top])):
                out += [(lang, s, part, item, -value, k + 1) for k, (value, item) in enumerate(items)]
    return sorted(out)


def frame(spark, rows):
    return odd_docs(spark, [(0, "")]).limit(0).select("lang", "source", "text", "doc_id", "key", "items").unionByName(
        spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "lang string, source string, text string, doc_id long, key int, items int")
    ).repartition(3)


def check(spark, rows, **params):
    assert sorted(map(tuple, D.audit(frame(spark, rows), **params).collect())) == plain(rows, **params)


def corpus(rng, n=260, sources=9, langs=("en", "fr", None)):
    words = [rng.choice(["a", "É", "Zß", "q", "Wort", "日"]) * rng.randrange(1, 4) + rng.choice("abcdefgh") for _ in range(90)]
    return [(rng.choice(langs), rng.choice([f"s{k}" for k in range(sources)] + [None]),
             " ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=rng.randrange(0, 60))) + "; x1y2 _z")
            for _ in range(n)]


def test_equals_plain(spark):
    rng = random.Random(1)
    rows = corpus(rng)
    rows += [("en", "s0", None), ("en", "alone", "  "), ("xx", "only", "never kept"), ("yy", "p", ""), ("yy", "q", None), (None, None, None),
             ("en", "s1", " ".join(rng.choices(["Aa", "bb"], k=40000)))] + [("en", "s2", "Copy copy COPY")] * 30
    check(spark, rows)
    check(spark, rows, min_docs=1, top=3)


def test_many_sources_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(D, "ROW_BLOCK", 7)
    monkeypatch.setattr(D, "UNIT_CELLS", 150)
    check(spark, corpus(random.Random(2), n=500, sources=40, langs=("en", "de")), min_docs=3)


def test_empty_table(spark):
    assert D.audit(empty_docs(spark)).collect() == []


def test_counts_pass_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(D, "HELD", 40)
    check(spark, corpus(random.Random(3), n=120), min_docs=2)


def test_share_is_exact_for_large_counts():
    rng = random.Random(4)
    for _ in range(300):
        total, kept = rng.randrange(1, 10**15), rng.randrange(1, 10**12)
        count = rng.randrange(0, total + 1)
        assert int(D.share(np.array([count]), np.array([total]), kept)[0]) == 1 + 10**9 * (count + 2) // (total + 2 * kept)


@pytest.mark.parametrize("seed", range(4))
def test_joint_traversal(seed):
    """The tree's sums are those of all cells, whatever is empty."""
    rng = np.random.default_rng(seed)
    na, nb, cols = int(rng.integers(1, 40)), int(rng.integers(1, 40)), int(rng.integers(1, 400))
    height = (max(-(-cols // D.COLS), -(-max(na, nb) // D.ROWS)) - 1).bit_length()
    trees, dense, zero = [], [], []
    for n in (na, nb):
        p0 = rng.integers(1, 1000, n)
        p = np.repeat(p0[:, None], cols, axis=1)
        hit = rng.random((n, cols)) < 0.03
        hit[:, :cols // 2] = False
        p[hit] = rng.integers(1, 10**9, int(hit.sum()))
        row, col = np.nonzero(hit)
        trees.append(D.QuadTree(row, col, p[row, col], p0, height))
        dense.append(p)
        zero.append(p0)
    got = D.joint(*trees, False).transpose(0, 2, 1, 3).reshape(trees[0].rows * D.ROWS, -1)[:na, :nb]
    want = D.apart(dense[0][:, None, :], dense[1][None, :, :]).sum(axis=2) - cols * D.apart(zero[0][:, None], zero[1][None, :])
    assert (got == want).all()
