import random
from collections import Counter

import numpy as np
import pytest
from epispark.llm import op3_simhash as H
from epispark.llm.components import components
from helpers_llm import empty_docs, odd_docs, odd_rows
from xxhash import xxh64_intdigest


def brute_fp(text):
    w = (text or "").encode().lower().split()
    sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([b" ".join(w)] if w else [])
    n = [0] * 64
    for s in sh:
        h = xxh64_intdigest(s, 42)
        for b in range(64):
            n[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * n[b] > len(sh))


def brute_components(nodes, near):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if near(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {x: find(x) for x in nodes}


def test_fingerprints(spark):
    rows = odd_rows()
    got = Counter((r.doc_id, r.fp & (2**64 - 1)) for r in H.fingerprints(odd_docs(spark)).collect())
    assert got == Counter((i, brute_fp(t)) for i, t in rows)


def test_golay_keys_reach_every_near_word():
    tables = H.golay_tables()
    table, count = tables
    assert set(count.tolist()) == {1, 6}
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 3000, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 3000).astype(np.uint64)
    for bits in range(4):
        y = x.copy()
        for i in range(len(y)):
            for b in rng.choice(64, bits, replace=False):
                y[i] ^= np.uint64(1) << np.uint64(b)
        keys = [set() for _ in range(2 * len(x))]
        row, key = H.segment_keys(np.concatenate([x, y]), tables)
        for r, k in zip(row.tolist(), key.tolist()):
            keys[r].add(k)
        assert all(keys[i] & keys[len(x) + i] for i in range(len(x)))


@pytest.mark.parametrize("block", [4, 512])
def test_links_against_brute_force(spark, block):
    rng = random.Random(2)
    fps = set()
    for _ in range(8):                          # chains and clouds around common centres
        c = rng.getrandbits(64)
        for _ in range(60):
            x = c
            for _ in range(rng.randrange(0, 9)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    links = H.near_links(spark.createDataFrame([(x,) for x in signed], "fp long"), 3, block).collect()
    for r in links:
        assert bin((r.u ^ r.v) & (2**64 - 1)).count("1") >= 1
    found = {x: x for x in signed}
    found.update({r.u: r.root for r in components(spark.createDataFrame([(r.u, r.v) for r in links], "u long, v long")).collect()})
    assert found == brute_components(signed, lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1") <= 3)


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 103), (103, 101), (200, 200)]
    got = {r.u: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100, 103: 100}


def test_groups(spark):
    rows = odd_rows()
    got = H.near_duplicates(odd_docs(spark)).collect()
    assert len(got) == len(rows)
    fp = {f"{brute_fp(t):016x}" for _, t in rows}
    roots = brute_components(fp, lambda a, b: bin(int(a, 16) ^ int(b, 16)).count("1") <= 3)
    low = {}
    for i, t in rows:
        r = roots[f"{brute_fp(t):016x}"]
        if i is not None:
            low[r] = min(low.get(r, i), i)
    assert Counter(tuple(r) for r in got) == Counter(
        (i, f"{brute_fp(t):016x}", low.get(roots[f"{brute_fp(t):016x}"])) for i, t in rows)


def test_empty(spark):
    assert H.near_duplicates(empty_docs(spark)).collect() == []
    with pytest.raises(ValueError):
        H.near_links(spark.createDataFrame([], "fp long"), 4)
