import math
import random
import zlib

from epispark.llm import op4_toxicity as T
from helpers_llm import empty_docs, odd_docs, words


def corpus(n=900, seed=4):
    rng = random.Random(seed)
    plain = words(rng, 300, 9)
    bad = ["blargface", "snortwit", "grumblehead", "zonkbrain"]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        text = [rng.choice(plain) if rng.random() < 0.7 else "".join(words(rng, 3)) for _ in range(rng.randrange(20, 200))]
        if toxic:
            for _ in range(max(2, len(text) // 25)):
                text.insert(rng.randrange(len(text)), rng.choice(bad))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_no_leak(spark):
    rows, labels = corpus()
    d, lab = odd_docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in T.toxicity(d, lab).collect()}
    assert len(got) == len(rows)
    truth = {i: y for i, _, y in labels}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out == (i in set(held)) for i in truth)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    right = sum(got[i].predicted == truth[i] for i in held) / len(held)
    assert right > 0.95
    # labels of held-out documents change nothing
    lied = spark.createDataFrame([(i, 1, 1 - y if i in set(held) else y) for i, _, y in labels], "doc_id long, quality int, toxic int")
    assert {r.doc_id: r.score for r in T.toxicity(d, lied).collect()} == {i: r.score for i, r in got.items()}
    kept = T.reject_toxic(d, lab)
    assert kept.columns == d.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.predicted == 0}


def test_odd_rows_and_labels(spark):
    rows, labels = corpus(300)
    d = odd_docs(spark, rows).unionByName(odd_docs(spark))
    lab = spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None), (10, 0, 1), (10, 0, 0), (99999, 1, 1)], "doc_id long, quality int, toxic int")
    got = T.toxicity(d, lab).collect()
    assert len(got) == d.count()
    blank = {r.score for r in got if r.doc_id in (1000, 1001, 1002, 1003)}
    assert len(blank) == 1


def test_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = T.toxicity(odd_docs(spark), none).collect()
    assert len({r.score for r in got}) == 1
    only = spark.createDataFrame([(i, 0) for i in range(20)], "doc_id long, toxic int")
    assert {r.predicted for r in T.toxicity(odd_docs(spark), only).collect()} == {0}


def test_empty(spark):
    lab = spark.createDataFrame([(1, 1), (4, 0)], "doc_id long, toxic int")
    assert T.toxicity(empty_docs(spark), lab).collect() == []
    assert T.reject_toxic(empty_docs(spark), lab).collect() == []


def test_scores_are_those_of_a_plain_run(spark):
    """Every score recomputed from the model by direct compression, word by word."""
    rows, labels = corpus(400, 6)
    rows += [(5000, None), (5001, ""), (5002, rows[3][1] + " " + rows[3][1])]
    d, lab = odd_docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = T.fit(d, lab)
    one, two = T._compressor(model.ordinary), T._compressor(model.toxic)
    got = {r.doc_id: r.score for r in T.toxicity(d, lab).collect()}
    for i, text in rows:
        words = "".join(c.lower() if c.isascii() and c.isalnum() else c if ord(c) > 127 else " " for c in text or "").split(" ")
        words = [w.encode() for w in words if w]
        far = [len(one(T.FRAME + w + b" ")) - len(two(T.FRAME + w + b" ")) for w in words]
        reach = [sum(x >= k for x in far) for k in (2, 3, 4, 5, 6)]
        x = [math.log1p(200 * n / max(1, len(words))) for n in reach] + [math.log1p(n) for n in reach] + [math.log1p(len(words))]
        z = sum(a * b for a, b in zip(x, model.weights)) + model.bias
        assert abs(got[i] - 1 / (1 + math.exp(-z))) < 1e-9


def test_all_words_of_the_sample_are_learnt_from(spark, monkeypatch):
    """Above 200,000 different words the dictionaries still see every one."""
    rng = random.Random(8)
    rows = [(i, " ".join("".join(rng.choices("abcdefghijklmnop", k=9)) for _ in range(600)) + (" zonkbrain" * 9 if i % 3 == 0 else ""))
            for i in range(1300)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
    given = []
    real = T._dictionary
    monkeypatch.setattr(T, "_dictionary", lambda samples, size: (given.append(len(samples)), real(samples[:2000], size))[1])
    monkeypatch.setattr(T, "ROUNDS", 1)
    T.fit(odd_docs(spark, rows), labels)
    learnt = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    assert given[0] > 200_000 and given[0] % 600 == 0 and given[0] // 600 <= sum(i % 3 > 0 for i in learnt)
    assert given[1] >= 100
