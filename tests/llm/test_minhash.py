import hashlib
import random
import re

import numpy as np
import pytest
from epispark.llm import op9_minhash as M
from helpers_llm import empty_docs, odd_docs, odd_rows, words

WORD = re.compile(rb"[^ \t-\r]+")


def shingles(text, k=5):
    w = WORD.findall((text or "").encode().lower())
    k = min(k, len(w))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_edited_texts_and_likeness(spark):
    rows = odd_rows()
    got = M.edited_fingerprints(odd_docs(spark)).collect()
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    got = sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    want = []
    for k, (i, t) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        e = M.edit(t, after)
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), jaccard(t, e), jaccard(t, after)))
    assert sorted(map(repr, ((r.doc_id, r.n_chars, r.edited_sha256) for r in got))) == sorted(map(repr, (w[:3] for w in want)))
    near = {(w[0], w[1], w[2]): w[3:] for w in want}
    for r in got:
        a, b = near[r.doc_id, r.n_chars, r.edited_sha256]
        assert abs(r.near_edited - a) < 0.25 and abs(r.near_next - b) < 0.25
    by_text = {}
    for (i, n, sha), r in (((r.doc_id, r.n_chars, r.edited_sha256), r) for r in got):
        pass
    texts = {(i, len(t or "")): t or "" for i, t in rows}
    for r in got:
        assert by_text.setdefault(texts[r.doc_id, r.n_chars], r.fingerprint) == r.fingerprint


@pytest.mark.parametrize("rows", [[(5, "one two three four")], [(1, None), (1, None)], [(None, "a b"), (2, "")]])
def test_few_rows(spark, rows):
    got = M.edited_fingerprints(odd_docs(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == sorted((i or 0, len(t or "")) for i, t in rows)


def test_signatures_estimate_jaccard():
    rng = random.Random(1)
    a, b = M.permutations(512)
    for share in (0.2, 0.5, 0.8):
        base = words(rng, 400, 9)
        other = base[:int(400 * share)] + words(rng, 400 - int(400 * share), 9)
        x, y = M.signatures([" ".join(base).encode(), " ".join(other).encode()], a, b)
        assert abs(M.likeness(x, y) - jaccard(" ".join(base), " ".join(other))) < 0.08
    empty, full = M.signatures([b" ", b"x"], a, b)
    assert M.likeness(empty, empty) == 1.0 and M.likeness(empty, full) == 0.0


def test_classes_against_brute_force(spark):
    rng = random.Random(9)
    rows = odd_rows()[:30]
    for g in range(4):
        base = words(rng, 120, 8)
        for k in range(12):
            own = list(base)
            for _ in range(k):
                own[rng.randrange(len(own))] = "changed" + str(rng.randrange(1000))
            rows.append((5000 + 20 * g + k, " ".join(own)))
    texts = sorted({t or "" for _, t in rows})
    root = {t: t for t in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, x in enumerate(texts):
        for y in texts[i + 1:]:
            if jaccard(x, y) >= 0.8:
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    low = {}
    for i, t in rows:
        if i is not None:
            r = find(t or "")
            low[r] = min(low.get(r, i), i)
    got = sorted(map(repr, map(tuple, M.similar(odd_docs(spark, rows)).collect())))
    assert got == sorted(repr((i, low.get(find(t or "")))) for i, t in rows)


def test_a_band_of_many_classes(spark, monkeypatch):
    """Texts that share a long passage and are no partners, beside near copies: blocks, and the same classes."""
    from epispark.llm import op12_jaccard_join as J
    for name, value in (("BLOCK", 8), ("WEIGHT", 900), ("LANDMARKS", 2)):
        monkeypatch.setattr(J, name, value)
    rng = random.Random(10)
    passage = words(rng, 60)
    rows = [(k, " ".join(passage + words(rng, rng.randrange(18, 45)))) for k in range(90)]
    rows += [(200 + k, rows[k][1] + " end" + str(k)) for k in range(0, 90, 2)]
    got = {r.doc_id: r.class_id for r in M.similar(odd_docs(spark, rows)).collect()}
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (a, x) in enumerate(rows):
        for b, y in rows[i + 1:]:
            if jaccard(x, y) >= 0.8:
                u, v = find(a), find(b)
                root[max(u, v)] = min(u, v)
    assert got == {i: find(i) for i, _ in rows} and len(set(got.values())) > 60


def test_empty(spark):
    assert M.edited_fingerprints(empty_docs(spark)).collect() == []
    assert M.similar(empty_docs(spark)).collect() == []


def test_permutations_are_odd_and_fixed():
    a, b = M.permutations(128)
    assert (a & np.uint64(1) == 1).all() and len(set(a.tolist())) == 128 and (M.permutations(128)[1] == b).all()


def plain_signature(text, a, b):
    """Minima of all hash functions in Python integers, one shingle at a time."""
    (x,) = M.shingle_sets([(text or "").encode()])
    values = [int(v) for v in x]
    return [min(((p * v + q) % 2**64 for v in values), default=2**64 - 1) >> 32 for p, q in zip(a, b)]


def test_fingerprints_recomputed(spark):
    rows = [r for r in odd_rows() if r[0] not in (None, 1010)]
    rows = list({i: (i, t) for i, t in rows}.values())
    a, b = ([int(v) for v in x] for x in M.permutations(M.N_PERM))
    texts = [t or "" for _, t in sorted(rows)]
    got = sorted(M.edited_fingerprints(odd_docs(spark, rows)).collect(), key=lambda r: r.doc_id)
    sigs = [plain_signature(t, a, b) for t in texts]

    def alike(x, y):
        empty = [2**32 - 1] * len(a)
        return float(x == y) if empty in (x, y) else sum(p == q for p, q in zip(x, y)) / len(x)

    for k, r in enumerate(got):
        after = (k + 1) % len(texts)
        edited = plain_signature(M.edit(texts[k], texts[after]), a, b)
        assert r.fingerprint == "".join(f"{v:08x}" for v in sigs[k]) and r.edited_fingerprint == "".join(f"{v:08x}" for v in edited)
        assert (r.near_edited, r.near_next) == (alike(sigs[k], edited), alike(sigs[k], sigs[after]))


def test_shingle_hashes_tell_shingles_apart():
    """Equal hashes for equal shingles and for no others, over all odd texts."""
    of = {}
    for _, t in odd_rows():
        w = WORD.findall((t or "").encode().lower())
        k = min(5, len(w))
        own = [tuple(w[i:i + k]) for i in range(len(w) - k + 1)] if w else []
        (x,) = M.shingle_sets([(t or "").encode()])
        assert len(x) == len(own)
        for shingle, h in zip(own, x.tolist()):
            assert of.setdefault(shingle, h) == h
    assert len(set(of.values())) == len(of)
