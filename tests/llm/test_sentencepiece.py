import math
from collections import Counter

import numpy as np
import pytest
from epispark.llm import op1_sentencepiece as S
from helpers_llm import empty_docs, odd_docs, odd_rows


@pytest.fixture(scope="module")
def vocab():
    return S.vocabulary()


def segmentations(text, ids):
    if not text:
        yield ()
        return
    for k in range(1, min(16, len(text)) + 1):
        if text[:k] in ids:
            for rest in segmentations(text[k:], ids):
                yield (ids[text[:k]],) + rest


@pytest.mark.parametrize("word,alpha", [("hello", 1.0), ("tations", 0.3), ("   a", 1.0)])
def test_samples_follow_the_lattice(vocab, word, alpha):
    codec = S.Codec(vocab, alpha)
    ids = {p: i for i, p in enumerate(vocab.pieces) if p}
    every = list(segmentations(" " + word, ids))
    weight = np.array([alpha * sum(vocab.weights[i] for i in s) for s in every])
    p = np.exp(weight - weight.max())
    p /= p.sum()
    n = 40000
    got, ends = codec.ids([word] * n, np.arange(n), 1)
    count = Counter(tuple(got[a:b].tolist()) for a, b in zip([0, *ends[:-1]], ends))
    assert set(count) <= set(every)
    for s, q in zip(every, p):
        assert abs(count[s] / n - q) < 5 * math.sqrt(q * (1 - q) / n) + 1e-3


def test_decoding_agrees_with_the_library(vocab):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=S.MODEL)
    codec = S.Codec(vocab)
    text = "Les élèves  of 日本 \U0001f600 went\thome"
    ids, ends = codec.ids([text], np.array([3]), 0)
    assert sp.decode(ids.tolist()) == text
    data, stops = codec.texts(np.array(sp.encode(text), dtype=np.int32), np.array([len(sp.encode(text))]))
    assert data[:stops[0]].tobytes().decode() == text


def test_round_trip_of_odd_rows(spark):
    rows = odd_rows()
    out = S.encode(odd_docs(spark), keep=["doc_id", "row"])
    got = out.collect()
    assert len(got) == len(rows)
    assert all(r.lossless is True and r.n_pieces == len(r.ids) for r in got if r.ids is not None)
    assert sum(r.ids is None for r in got) == sum(t is None for _, t in rows)
    back = S.decode(out).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter(rows)


def test_same_ids_whatever_the_batches(spark):
    a = {r.doc_id: r.ids for r in S.encode(odd_docs(spark)).collect()}
    b = {r.doc_id: r.ids for r in S.encode(odd_docs(spark).repartition(7)).collect()}
    c = {r.doc_id: r.ids for r in S.encode(odd_docs(spark), seed=1).collect()}
    assert a == b and a != c


def test_large_alpha_gives_the_best_segmentation(vocab):
    ids = {p: i for i, p in enumerate(vocab.pieces) if p}
    best = max(segmentations(" reading", ids), key=lambda s: sum(vocab.weights[i] for i in s))
    got, _ = S.Codec(vocab, 200.0).ids(["reading"], np.array([1]), 0)
    assert tuple(got.tolist()) == best


def test_empty(spark):
    assert S.encode(empty_docs(spark)).collect() == []
    assert S.decode(S.encode(empty_docs(spark))).collect() == []
