import hashlib
import re
from collections import Counter, defaultdict

import pytest
from epispark.llm import op7_line_dedup as D
from helpers_llm import SCHEMA, empty_docs, odd_docs, odd_rows

BIG = 2**63 - 1


def key(line):
    return re.sub("^[ \t-\r]+|[ \t-\r]+$", "", line).translate({c: c + 32 for c in range(65, 91)})


def brute(rows, n=10):
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(BIG if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= n and min(holders[key(x)]) < (BIG if i is None else i))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("bits", [1 << 16, 1 << 28])
def test_against_brute_force(spark, bits):
    got = Counter(tuple(r) for r in D.dedup_lines(odd_docs(spark), max_filter_bits=bits).collect())
    assert got == Counter((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(odd_rows()))


def test_crowded_filter_changes_nothing(spark):
    rows = [(i, "\n".join(f"line number {(i * 7 + j) % 2500} of all" for j in range(300))) for i in range(60)]
    got = Counter(tuple(r) for r in D.dedup_lines(odd_docs(spark, rows), max_filter_bits=1 << 16).collect())
    assert got == Counter((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(rows))


def test_columns_are_carried(spark):
    got = D.drop_lines(odd_docs(spark))
    assert got.columns == odd_docs(spark).columns
    assert Counter((r.doc_id, r.text, r.lines) for r in got.collect()) == Counter(
        (i, None if o is None else t, 8) for (i, o), (_, _, _, t) in zip(odd_rows(), brute(odd_rows())))


def test_empty(spark):
    assert D.dedup_lines(empty_docs(spark)).collect() == []
    assert D.drop_lines(empty_docs(spark)).schema.names == [c.split()[0] for c in SCHEMA.split(", ")]
