import random
from collections import Counter

import numpy as np
import pytest
from epispark.llm import op12_jaccard_join as J
from helpers_llm import empty_docs, odd_docs, odd_rows, words
from test_simhash import brute_components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=5):
    w = [x for x in "".join(" " if c in "\t\n\v\f\r" else c for c in (text or "").translate(LOW)).split(" ") if x]
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def plain(rows, threshold=80, width=5):
    sets = [frozenset(shingles(t, width)) for _, t in rows]
    distinct = list({s for s in sets if s})

    def near(a, b):
        n = len(distinct[a] & distinct[b])
        return 100 * n >= threshold * (len(distinct[a]) + len(distinct[b]) - n)
    root = brute_components(range(len(distinct)), near)
    place = {s: root[k] for k, s in enumerate(distinct)}
    low = {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            low[place[s]] = min(low.get(place[s], i), i)
    return Counter((i, len(s), low.get(place[s]) if s else i) for (i, _), s in zip(rows, sets))


def check(spark, rows, **params):
    got = Counter(tuple(r) for r in J.jaccard_components(odd_docs(spark, rows), **params).collect())
    want = plain(rows, **{k: v for k, v in params.items()})
    assert got == want, (got - want, want - got)


def family(rng, n, size, edits, start):
    base = words(rng, size)
    out = []
    for k in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            at = rng.randrange(len(w))
            w[at:at + rng.randrange(2)] = words(rng, rng.randrange(3))
        out.append((start + k, " ".join(w)))
    return out


def corpus(rng):
    rows = odd_rows()
    for k in range(12):
        rows += family(rng, rng.randrange(2, 9), rng.randrange(6, 200), 3, 2000 + 100 * k)
    passage = " ".join(words(rng, 60))
    rows += [(9000 + k, passage + " " + " ".join(words(rng, rng.randrange(0, 40)))) for k in range(30)]
    rows += [(9100 + k, rows[k][1]) for k in range(10)] + [(None, rows[3][1]), (9200, "one two three"), (9201, "ONE  two\tthree"), (9202, "one two")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("threshold", [80, 55, 100])
def test_equals_plain(spark, threshold):
    check(spark, corpus(random.Random(threshold)), threshold=threshold)


def test_large_groups_in_blocks(spark, monkeypatch):
    """Small blocks, spread keys and few landmarks: many units, same components."""
    for name, value in (("BLOCK", 6), ("WEIGHT", 600), ("LANDMARKS", 2), ("CHUNK", 7), ("HOT", 20), ("HOT_KEYS", 1 << 30)):
        monkeypatch.setattr(J, name, value)
    rng = random.Random(5)
    rows = corpus(rng) + family(rng, 150, 60, 5, 20000) + family(rng, 60, 90, 12, 30000)
    check(spark, rows)


def test_empty_table(spark):
    assert J.jaccard_components(empty_docs(spark)).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_trie_join(seed):
    """The trie's links span the components of all pairs, and are links."""
    rng = np.random.default_rng(seed)
    base = [np.arange(40), np.arange(20, 70), rng.choice(500, 30, replace=False)]
    sets = [np.unique(rng.integers(0, 500, rng.integers(1, 20)))]
    for _ in range(120):
        b = base[rng.integers(3)]
        sets.append(np.unique(np.concatenate([b[rng.random(len(b)) < 0.93], rng.integers(0, 500, rng.integers(0, 5))])))
    sets = [np.array(s) for s in {tuple(s.tolist()) for s in sets if len(s)}]
    threshold = [80, 60, 90][seed % 3]

    def near(a, b):
        n = len(np.intersect1d(sets[a], sets[b]))
        return 100 * n >= threshold * (len(sets[a]) + len(sets[b]) - n)
    got = J.Trie(sets, np.arange(len(sets)), threshold).links()
    assert all(near(a, b) for a, b in got)
    want = brute_components(range(len(sets)), near)
    links = {frozenset(x) for x in got}
    assert brute_components(range(len(sets)), lambda a, b: frozenset((a, b)) in links) == want
