import os
from collections import Counter

import corpus_pipeline as P
import pytest
from epispark.llm import op3_simhash, op4_toxicity, op10_decontamination
from epispark.llm.queries import ORACLE_SQL, QUERIES
from helpers_llm import empty_docs, odd_docs, odd_rows

SF = "/root/testdata/sf0.001"


def test_stages_are_the_five_in_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "encoding"]
    assert P.ORACLE_SQL is None
    names = [k for k in QUERIES if k.startswith("op")]
    assert sorted(int(k[2:].split("_")[0]) for k in names) == list(range(1, 14)) and "pipeline" in QUERIES
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before and after every stage over the documents of the test table."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, f in P.STAGES:
        docs = P.saved(f(spark, docs, SF), "test-stage")
        out.append(docs)
    return out


def test_columns_and_decisions(spark, stages):
    docs, kept, lined, single, clean, encoded = stages
    for d in (kept, lined, single, clean):
        assert d.columns == docs.columns and d.dtypes == docs.dtypes
    model = op4_toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scored = op4_toxicity.score(docs, model).select("row.doc_id", "score").collect()
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in scored if r.score < 0.3}
    assert lined.count() == kept.count()
    groups = op3_simhash.near_duplicates(lined).collect()
    assert Counter(r.doc_id for r in single.collect()) == Counter({r.component_id: 1 for r in groups})
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    found = op10_decontamination.contamination(single, bench).collect()
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in found if not r.contaminated}
    assert {r.doc_id for r in encoded.collect()} == {r.doc_id for r in clean.collect()}
    assert all(r.lossless for r in encoded.collect())


def test_lines_against_brute_force(stages):
    from test_line_dedup import brute
    _, kept, lined, *_ = stages
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert Counter((r.doc_id, r.text, r.n_chars) for r in lined.collect()) == Counter((i, t, len(t)) for i, _, _, t in brute(rows))


def test_run_is_the_stages(spark, stages):
    got = {r.doc_id: r.ids for r in P.run(spark, SF).collect()}
    assert got == {r.doc_id: r.ids for r in stages[-1].collect()}


@pytest.mark.parametrize("rows", [None, []])
def test_odd_rows_pass_every_stage(spark, rows):
    docs = odd_docs(spark) if rows is None else empty_docs(spark)
    columns = docs.columns
    for name, f in P.STAGES:
        docs = P.saved(f(spark, docs, SF), "test-odd")
        if name != "encoding":
            assert docs.columns == columns, name
    got = {r.doc_id for r in docs.collect()}
    if rows is None:
        assert got and got <= {i for i, _ in odd_rows()}
        assert 1005 not in got                                       # what lines it keeps equal 1004's
    else:
        assert got == set()


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for top, _, files in os.walk(os.path.join(root, "epispark")):
        if "llm" not in os.path.relpath(top, root).split(os.sep):
            for f in files:
                if f.endswith(".py"):
                    assert "llm" not in open(os.path.join(top, f)).read(), f


def test_near_duplicates_are_judged_row_by_row(spark):
    import random
    rng = random.Random(5)
    text = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(60))
    a, b, c, d = text(), text(), text(), text()
    rows = [(1, a), (7, a), (7, b),                     # the clean row of an id stays
            (8, c), (8, c), (8, c + " "), (9, c),       # one of rows with one id
            (None, d), (None, d), (None, a)]
    got = P.near_duplicates(spark, odd_docs(spark, rows), SF)
    assert got.columns == odd_docs(spark).columns
    assert sorted((r.doc_id or 0, r.text.strip()) for r in got.collect()) == sorted([(1, a), (7, b), (8, c), (0, d)])
