import base64
import hashlib
import random
from collections import Counter, defaultdict

import pytest
import tiktoken
from epispark.llm import op8_token_counts as T
from helpers_llm import empty_docs, odd_docs, odd_rows

RAW = open(T.RANKS, "rb").read()
ENC = tiktoken.Encoding("own", pat_str=T.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, RAW.splitlines())},
                        special_tokens={})


def applied(text, start, length, replacement):
    start = min(max(start or 0, 0), len(text))
    return text[:start] + (replacement or "") + text[min(len(text), start + max(length or 0, 0)):]


def test_random_edits_against_a_new_split():
    counter, rng = T.Counter(RAW), random.Random(3)
    parts = ["a", "b", " ", "  ", "\n", "'s", "1", "é", "!", "\t", "'", "re", "  \n ", "日", "\x00", " "]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(0, 40)))
        tree = T.Tree(text, counter)
        for _ in range(rng.randrange(1, 7)):
            e = rng.randrange(-1, len(text) + 3), rng.randrange(-1, 9), "".join(rng.choice(parts) for _ in range(rng.randrange(0, 5)))
            text = applied(text, *e)
            tree.edit(*e)
            assert tree.text() == text and tree.pieces() == counter.split(text)
            assert tree.n_tokens == len(ENC.encode_ordinary(text)) and tree.n_chars == len(text)
            assert tree.find(max(0, tree.n_chars - 1))[1] <= tree.n_chars


def test_an_edit_touches_few_pre_tokens():
    tree = T.Tree("some words here " * 5000, T.Counter(RAW))
    tree.edit(40_000, 5, "other")
    assert tree.encoded <= 8


def edits():
    rng = random.Random(8)
    rows = []
    for i, t in odd_rows():
        for k in range(rng.randrange(0, 5)):
            rows.append((i, k, rng.randrange(0, 200), rng.randrange(0, 30), rng.choice(["", " new words", "\n", "é"]), 1))
    return rows + [(4242, 0, 0, 1, "x", 1), (0, None, None, None, None, 1), (3, 9, 10**12, 5, " end", 1), (3, 10, -4, -4, "begin ", 1)]


def check(spark, rows, e):
    by_id = defaultdict(list)
    for i, seq, start, length, rep, _ in e:
        if i is not None:
            by_id[i].append((max(seq or 0, 0), -(10**18) if start is None else start, -(10**18) if length is None else length, rep or ""))
    want = Counter()
    for i, t in rows:
        text = t or ""
        before = len(T.Counter(RAW).split(text)), len(ENC.encode_ordinary(text))
        own = sorted(by_id[i]) if i is not None else []
        for _, s, n, rep in own:
            text = applied(text, s, n, rep)
        want[(i, *before, len(own), len(ENC.encode_ordinary(text)), hashlib.sha256(text.encode()).hexdigest())] += 1
    frame = spark.createDataFrame(e, "doc_id long, seq int, start long, length long, replacement string, text int")
    got = T.count_with_edits(odd_docs(spark, rows), frame)
    assert Counter((r.doc_id, r.n_pretokens, r.n_tokens, r.n_edits, r.edited_tokens, r.edited_sha256) for r in got.collect()) == want


def test_against_brute_force(spark):
    check(spark, odd_rows(), edits())


def test_ids_of_their_own(spark):
    rows, seen = [], set()
    for i, t in odd_rows():
        if i not in seen:
            seen.add(i)
            rows.append((i, t))
    check(spark, rows, edits())


def test_many_rows_of_one_id(spark, monkeypatch):
    """Copies, other texts and nulls under one id: a row each, edited alike; one tree is open at a time."""
    monkeypatch.setattr(T, "ROWS_OUT", 7)
    rows = [(7, f"text number {k % 9} of one id" if k % 9 else None) for k in range(60)] + [(8, "alone"), (None, "a"), (None, "a"), (None, None)]
    e = [(7, 0, 5, 6, "piece", 1), (7, 1, 0, 0, "the ", 1), (8, 0, 5, 0, " now", 1)]
    check(spark, rows, e)
    counter = T._counted(type("Shared", (), {"value": RAW}))
    most = []

    class Watched(T.Tree):
        alive = 0

        def __init__(self, *a):
            super().__init__(*a)
            Watched.alive += 1
            most.append(Watched.alive)

        def __del__(self):
            Watched.alive -= 1

    monkeypatch.setattr(T, "Tree", Watched)
    import pyarrow as pa
    placed = [(7, k, -1, None, None, f"text {k}", 3) for k in range(50)]
    batch = pa.RecordBatch.from_arrays([pa.array(list(c), pa.string() if n == "text" else pa.int64())
                                        for c, n in zip(zip(*placed), T._COLUMNS)], list(T._COLUMNS))
    assert sum(b.num_rows for b in counter(iter([batch]))) == 150 and max(most) <= 3


@pytest.mark.parametrize("n", [0, 1])
def test_empty(spark, n):
    frame = spark.createDataFrame([(1, 1, 1, 1, "x")] * n, "doc_id long, seq int, start long, length long, replacement string")
    assert T.count_with_edits(empty_docs(spark), frame).collect() == []
    assert T.count_with_edits(odd_docs(spark), frame).count() == len(odd_rows())
