"""Physical-plan properties that matter at scale."""
import pytest
from pyspark.sql import functions as F

from epispark.operators import clean as CL
from epispark.operators import index as IX
from epispark.operators import update as UP
from epispark.plans import catalog
from conftest import SF_SMALL
from helpers import raw_df


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scope_filter_reaches_parquet_scan(spark):
    i = catalog.inputs(spark, SF_SMALL)
    p = plan_of(CL.clean(i.raw, catalog.YEAR_CFG, i.aliases))
    assert "EqualTo(epi_year,1998)" in p


def test_area_table_partial_aggregation(spark):
    i = catalog.inputs(spark, SF_SMALL)
    p = plan_of(IX.area_table(i.clean))
    assert p.index("partial_count") > p.index("Exchange hashpartitioning")  # map side first


def test_update_dedup_is_partial_aggregate(spark):
    base = raw_df(spark, [{"case_id": 1}])
    p = plan_of(UP.merge(base, base))
    assert "partial_min_by" in p and "Window" not in p


SIDE_EFFECT = ("src_cases", "src_population", "src_clean", "stm_incremental_merge")


def test_no_cartesian_or_nested_loop_joins(spark):
    import __spark_entry__ as E
    qs = E.queries()
    for k in sorted(E.oracle_sql()):
        if k in SIDE_EFFECT:
            continue
        p = plan_of(qs[k](spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, k


def test_unpartitioned_windows_only_on_bounded_aggregates(spark):
    i = catalog.inputs(spark, SF_SMALL)
    p = plan_of(i.index)
    # the only window is the cumulative count over the score histogram
    assert p.count("Window [") <= 1
    assert "sum(_cnt" in p


def test_hot_id_merge(spark):
    """A third of the incoming rows share one id: still one row per id."""
    rows = [{"case_id": 7, "age": a % 90} for a in range(60)] + \
           [{"case_id": 100 + i} for i in range(120)]
    new = raw_df(spark, rows)
    base = raw_df(spark, [{"case_id": 7, "age": 1}])
    m = UP.merge(base, new)
    assert m.count() == 121
    assert m.where(F.col("case_id") == 7).first()["age"] == 1


@pytest.mark.parametrize("parts", ["1", "8"])
def test_merge_independent_of_partitions(spark, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        new = raw_df(spark, [{"case_id": i % 5, "age": i} for i in range(40)])
        got = sorted((r["case_id"], r["age"]) for r in UP.merge(new.limit(0), new).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == [(0, 0), (1, 1), (2, 2), (3, 3), (4, 4)]


def test_incremental_append_does_not_shuffle_the_base(spark, tmp_dir):
    base = raw_df(spark, [{"case_id": i} for i in range(50)])
    base.write.parquet(f"{tmp_dir}/base")
    stored = spark.read.parquet(f"{tmp_dir}/base")
    new = raw_df(spark, [{"case_id": i} for i in range(45, 55)])
    found = UP.existing_ids(stored, new)
    found.collect()
    p = plan_of(found)                       # as re-planned on the measured sizes
    assert "BroadcastHashJoin" in p and "LeftSemi" in p
    scan = [ln for ln in p.splitlines() if "FileScan parquet" in ln][0]
    assert "ReadSchema: struct<case_id:bigint>" in scan          # only the id column is read
