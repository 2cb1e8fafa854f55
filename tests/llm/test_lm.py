import math
import zlib
from collections import Counter

import numpy as np
import pytest
from epispark.llm import op6_lm_scoring as L
from helpers_llm import empty_docs, odd_docs, odd_rows


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def brute(rows):
    toks = [(t or "").encode().lower().split() + [None] for _, t in rows]
    c, pairs, n_docs = Counter(), Counter(), 0
    train = []
    for (i, _), t in zip(rows, toks):
        if not held(i):
            n_docs += 1
            c.update(t)
            pairs.update(zip([0, *t[:-1]], t))
            train.append(t)
    n, v = sum(c.values()), len(c)
    before = lambda a: n_docs if a == 0 else c[a]
    p0 = lambda w, d=0: (c[w] - d + 0.5) / (n - d + 0.5 * (v + 1))
    ratios = {}
    for t in train:                              # deleted: each token is held out of its own counts
        for a, w in zip([0, *t[:-1]], t):
            if before(a) > 1:
                ratios.setdefault(int(math.log2(before(a) - 1)), []).append((pairs[a, w] - 1) / (before(a) - 1) / p0(w, 1))
    weight = {}
    for b, r in ratios.items():
        r, x = np.array(r), 0.5
        for _ in range(300):
            x = min(float((x * r / (1 - x + x * r)).mean()), 1 - 1e-6)
        weight[b] = x
    out = []
    for (i, _), t in zip(rows, toks):
        base = sum(math.log10(p0(w)) for w in t)
        score = 0.0
        for a, w in zip([0, *t[:-1]], t):
            x = weight.get(int(math.log2(before(a))), 0.0) if before(a) else 0.0
            ml = pairs[a, w] / before(a) if before(a) else 0.0
            score += math.log10((1 - x) * p0(w) + x * ml)
        out.append((i, held(i), len(t), sum(c[w] > 0 for w in t), n, base, score))
    return out


@pytest.mark.parametrize("chunk", [300, 2_000_000])
def test_against_brute_force(spark, chunk):
    rows = [r for r in odd_rows(n=120) if r[0] != 1010]
    got = sorted(map(tuple, L.scores(odd_docs(spark, rows), chunk).collect()), key=lambda r: (str(r[0]), r[2], r[5]))
    want = sorted(brute(rows), key=lambda r: (str(r[0]), r[2], r[5]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert abs(g[5] - w[5]) < 1e-7 * max(1, abs(w[5]))
        assert abs(g[6] - w[6]) < 1e-3 * max(1, abs(w[6])), (g, w)       # a bin of the histogram stands for its tokens' mean place


def test_em_finds_the_weight():
    rng = np.random.default_rng(0)
    for true in (0.1, 0.6, 0.9):
        ratio = np.array([0.0, 8.0])
        high = rng.random(200_000) < true * 0.9 + (1 - true) * 0.9 / 8
        h = np.zeros((L.BUCKETS, L.BINS))
        h[3, 0] = (~high).sum()
        h[3, 1 + (3 - L.LOW) * L.FINE] = high.sum()
        x = L.mixture_weights(h)[3]
        r = np.where(high, ratio[1] * 2 ** (0.5 / L.FINE), 0.0)
        score = lambda y: np.log(1 - y + y * r).sum()
        assert all(score(x) >= score(np.clip(x + d, 0, 1 - 1e-6)) - 1e-3 for d in (-0.01, 0.01))


def test_packing():
    for x in ([], [0], [1, 255, 256], [2**40, 3, 0]):
        assert L.unpack(L.pack(np.array(x, dtype=np.int64))).tolist() == x


def test_what_is_shuffled_comes_back():
    for x in ([], [7], range(10_000), [2**50] * 500, [3, 1, 2]):
        assert L.expand(L.squeeze(np.array(x, dtype=np.int64))).tolist() == list(x)


def test_small_rows_travel_together():
    lines = [(b, L.WORDS, 1, 2, b"12345678", b"12", b"") for b in range(3000)]
    batches = list(L._batches(iter(lines)))
    assert [b.num_rows for b in batches] == [1024, 1024, 952]
    assert list(L._rows(iter(batches))) == lines
    assert len(list(L._batches(iter([(0, L.HOME, 1, 2, bytes(L.BATCH_BYTES), b"", b"")] * 3)))) == 3
    assert list(L._batches(iter([]))) == []


@pytest.mark.parametrize("buckets", [1, 7, 5000])
def test_entries_by_bucket(buckets):
    rng = np.random.default_rng(buckets)
    h, counts = rng.integers(0, 2**63, 2000).astype(np.uint64) * np.uint64(2), rng.integers(0, 50, 2000)
    found = {}
    for dest, kind, chunk, n, keys, packed, _ in L._entries(L.PAIRS, 9, h, counts, buckets):
        back = L._hashes(keys)
        assert (kind, chunk, n) == (L.PAIRS, 9, len(back)) and 0 <= dest < buckets
        found.update(zip(back.tolist(), L.expand(packed).tolist()))
    assert found == dict(zip((h >> np.uint64(64 - L.HASH_BITS)).astype(np.int64).tolist(), counts.tolist()))


def test_empty_and_untrained(spark):
    assert L.scores(empty_docs(spark)).collect() == []
    i = next(i for i in range(100) if held(i))
    (r,) = L.scores(odd_docs(spark, [(i, "a b")])).collect()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) == (True, 3, 0, 0, 0.0, 0.0)
