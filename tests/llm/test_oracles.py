import duckdb
import pytest
from epispark.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(ORACLE_SQL[key])
    got = QUERIES[key](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())


@pytest.mark.parametrize("key", ["op2_sharding_kk", "op4_toxicity_zstd", "op5_html_suffix_array", "op8_token_counts_edits"])
def test_query_returns_a_row_for_every_row(spark, key):
    table = "pages" if key.startswith("op5") else "documents"
    assert QUERIES[key](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
