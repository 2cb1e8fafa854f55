import hashlib
import random
import re
from collections import Counter

import pytest
from epispark.llm import op10_decontamination as D
from helpers_llm import empty_docs, odd_docs, odd_rows

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(t):
    return WORD.findall((t or "").encode().lower())


def brute(rows, bench, window=10):
    out = []
    for i, t in rows:
        w, hit, items = split(t), set(), set()
        for name, text in bench:
            p = split(text)
            m = min(window, len(p))
            for k in range(len(p) - m + 1 if m else 0):
                for a in range(len(w) - m + 1):
                    if w[a:a + m] == p[k:k + m]:
                        hit.update(range(a, a + m))
                        items.add(str(name))
        out.append((i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


def sample(seed=3):
    rng = random.Random(seed)
    rows = [r for r in odd_rows() if r[0] != 1010]
    texts = [t for _, t in rows if t]
    bench = [(k, " ".join(rng.choice(texts).split()[:rng.randrange(1, 25)])) for k in range(12)]
    bench += [(50, None), (51, ""), (52, "?!"), (53, bench[0][1]), (7, "x"), (54, "a b"), (55, "a a a a a a a a a a a a")]
    rows += [(2000 + k, "before " + b.upper() + ", after") for k, (_, b) in enumerate(bench) if b] + [(3000, "a " * 40)]
    return rows, bench


@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
def test_against_brute_force(spark, block_bytes):
    rows, bench = sample()
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = D.contamination(odd_docs(spark, rows), items if block_bytes > 1 else items.limit(9), block_bytes=block_bytes)
    assert Counter(tuple(r) for r in got.collect()) == brute(rows, bench if block_bytes > 1 else [tuple(r) for r in items.limit(9).collect()])


def test_small_windows_and_common_words():
    rng = random.Random(0)
    bench = [(k, " ".join(rng.choice("ab") for _ in range(rng.randrange(1, 9)))) for k in range(15)]
    rows = [(k, " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 700)))) for k in range(20)]
    import pyarrow as pa
    n, hits, items = D.Block([(str(a), b) for a, b in bench], 4).find(pa.array([t for _, t in rows]))
    want = brute(rows, bench, 4)
    got = Counter((i, int(n[i]), D.covered(hits[i]), len(items[i]), hashlib.sha256(",".join(sorted(items[i])).encode()).hexdigest(),
                   bool(hits[i])) for i in range(len(rows)))
    assert got == want


def test_clean_documents(spark):
    rows, bench = sample()
    clean = D.clean_documents(odd_docs(spark, rows), spark.createDataFrame(bench, "item_id long, text string"))
    assert clean.columns == odd_docs(spark).columns
    want = {(i, n): c for (i, n, _, _, _, hit), c in brute(rows, bench).items() if not hit}
    assert sum(want.values()) == clean.count()
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in want}


def test_empty(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert D.contamination(empty_docs(spark), bench).collect() == []
    assert {r.contaminated for r in D.contamination(odd_docs(spark), bench).collect()} == {False}


@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
def test_items_without_an_id(spark, block_bytes):
    a, b, c = (" ".join(f"{k}word{i}" for i in range(12)) for k in "abc")
    bench = spark.createDataFrame([(None, a), (None, b), (3, c)], "item_id long, text string")
    rows = [(1, a), (2, f"{a} {b} {c}"), (3, "none of them"), (4, c)]
    got = {r.doc_id: r for r in D.contamination(odd_docs(spark, rows), bench, block_bytes=block_bytes).collect()}
    sha = {x: hashlib.sha256(x.encode()).hexdigest() for x in ("", "3")}
    assert {i: (r.n_hit, r.n_items, r.items_sha256) for i, r in got.items()} == {
        1: (12, 1, sha[""]), 2: (36, 2, sha["3"]), 3: (0, 0, sha[""]), 4: (12, 1, sha["3"])}
    assert [r.doc_id for r in D.clean_documents(odd_docs(spark, rows), bench, block_bytes=block_bytes).collect()] == [3]


def test_a_block_takes_few_bytes_for_each_of_its_own():
    import tracemalloc
    rng = random.Random(9)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(20000)]
    items = [(str(k), " ".join(rng.choices(vocabulary, k=200))) for k in range(1500)]
    size = sum(len(t) for _, t in items)
    D.Block(items)                          # the powers of the hash are kept for all
    tracemalloc.start()
    block = D.Block(items)
    kept, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    tables = len(block.matchers) * (4 << D.TABLE_BITS)
    assert kept - tables < 9 * size and peak - tables < 40 * size
    import pyarrow as pa
    _, hits, found = block.find(pa.array(["x " + items[7][1].upper() + " y", "none of it"]))
    assert D.covered(hits[0]) == 200 and found[0] == {"7"} and not hits[1]
