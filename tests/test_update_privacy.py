from pyspark.sql import functions as F

from epispark.operators import privacy as PV
from epispark.operators import update as UP
from helpers import raw_df


def test_merge_base_wins_and_report(spark):
    base = raw_df(spark, [{"case_id": 1, "age": 10}, {"case_id": 2, "age": 20}])
    new = raw_df(spark, [{"case_id": 2, "age": 99}, {"case_id": 3, "age": 30},
                         {"case_id": 3, "age": 30}])
    m = {r["case_id"]: r["age"] for r in UP.merge(base, new).collect()}
    assert m == {1: 10, 2: 20, 3: 30}
    rep = UP.update_report(base, new).first()
    assert (rep["existing"], rep["incoming"], rep["duplicates"], rep["added"]) == (2, 3, 2, 1)


def test_update_idempotent(spark):
    base = raw_df(spark, [{"case_id": 1}, {"case_id": 2}])
    once = UP.merge(base, base)
    assert once.count() == 2
    assert UP.update_report(once, base).first()["added"] == 0


def test_null_ids_collapse(spark):
    base = raw_df(spark, [{"case_id": None, "age": 1}, {"case_id": None, "age": 2}])
    assert UP.merge(base, base.limit(0)).count() == 1


def test_base_duplicates_make_added_negative(spark):
    base = raw_df(spark, [{"case_id": 1}, {"case_id": 1}])
    assert UP.update_report(base, base.limit(0)).first()["added"] == -1


def test_anti_join_equivalence(spark):
    base = raw_df(spark, [{"case_id": i} for i in range(5)])
    new = raw_df(spark, [{"case_id": i} for i in range(3, 8)])
    a = sorted(r["case_id"] for r in UP.merge(base, new).collect())
    b = sorted(r["case_id"] for r in UP.merge_by_anti_join(base, new).collect())
    assert a == b == list(range(8))


def test_suppression_and_k_check(spark):
    df = spark.createDataFrame([("a", 3), ("b", 5), ("c", 9)], "k string, cases bigint")
    pub = PV.suppress(df, "cases", 5)
    assert sorted(r["k"] for r in pub.collect()) == ["b", "c"]
    chk = PV.k_anonymity_check(pub).first()
    assert chk["is_safe"] and chk["min_cell"] == 5
    bad = PV.k_anonymity_check(df.withColumn("case_id", F.lit(1))).first()
    assert not bad["is_safe"] and bad["n_case_level_columns"] == 1


def test_incremental_new_rows_equals_full_merge(spark):
    base = raw_df(spark, [{"case_id": i, "age": i} for i in range(6)] + [{"case_id": None,
                                                                          "age": 50}])
    new = raw_df(spark, [{"case_id": i, "age": 90 + i} for i in range(4, 9)] +
                 [{"case_id": 8, "age": 1}, {"case_id": None, "age": 60}])
    full = sorted((r["case_id"] or -1, r["age"]) for r in UP.merge(base, new).collect())
    inc = base.unionByName(UP.new_rows(base, new))
    got = sorted((r["case_id"] or -1, r["age"]) for r in inc.collect())
    assert got == full
    assert UP.new_rows(base, new).count() == 3            # ids 6, 7, 8 (first of the two 8s)


def test_anti_join_counts_null_ids_as_one_and_repeats_once(spark):
    base = raw_df(spark, [{"case_id": None, "age": 1}, {"case_id": 1, "age": 2}])
    new = raw_df(spark, [{"case_id": None, "age": 3}, {"case_id": 2, "age": 4}, {"case_id": 2, "age": 5}])
    a = sorted((r["case_id"] or -1, r["age"]) for r in UP.merge(base, new).collect())
    b = sorted((r["case_id"] or -1, r["age"]) for r in UP.merge_by_anti_join(base, new).collect())
    assert a == b == [(-1, 1), (1, 2), (2, 4)]


def test_the_first_row_of_the_file_stays(spark, tmp_dir):
    from epispark.sources import cases as SRC
    with open(f"{tmp_dir}/new.csv", "w") as f:
        f.write("case_id,age\n7,90\n8,1\n7,10\n")
    rows = SRC.read_cases(spark, f"{tmp_dir}/new.csv", ordinal=True)
    got = UP.dedup_first(rows.withColumn(UP.SOURCE_COL, F.lit(1)))
    assert got.columns == ["case_id", "age"]
    assert {r["case_id"]: r["age"] for r in got.collect()} == {"7": 90, "8": 1}


def test_updates_equal_one_run_over_all_rows(spark, tmp_dir):
    from epispark.config import Config
    from epispark.operators import clean as CL, index as IX
    from epispark.plans import workflows
    from epispark.sources.cases import empty_population
    from epispark.streaming import incremental as INC
    cfg = Config(year=2024, model_features=Config().model_features)
    mk = lambda ids: raw_df(spark, [{"case_id": i, "region_code": str(1 + i % 3), "region_name": f"R{i % 3}",
                                     "local_code": str(i % 7), "local_name": f"L{i % 7}", "age": i % 90,
                                     "epi_week": 1 + i % 52} for i in ids])
    pop = empty_population(spark)
    base, one, two = mk(range(60)), mk(range(50, 140)), mk(range(100, 200))
    workflows.update(spark, base, one, pop, tmp_dir, 1, cfg)
    first = INC.read_table(spark, f"{tmp_dir}/clean").inputFiles()
    done = workflows.update(spark, base, two, pop, tmp_dir, 2, cfg)
    assert set(first) <= set(INC.read_table(spark, f"{tmp_dir}/clean").inputFiles())      # stored files stay
    got = sorted(map(tuple, spark.read.parquet(done["areas"]).collect()))
    whole = IX.index_flow(CL.clean(mk(range(200)), cfg), pop, cfg)
    assert got == sorted(map(tuple, whole.select(*spark.read.parquet(done["areas"]).columns).collect()))
    again = workflows.update(spark, base, two, pop, tmp_dir, 2, cfg)
    assert again["report"] == done["report"]
    pub = workflows.republish(spark, tmp_dir, 1, f"{tmp_dir}/pub")
    assert spark.read.parquet(pub["areas"]).agg({"cases": "sum"}).first()[0] <= 140


def test_rows_of_single_ids_are_not_sorted(spark, monkeypatch):
    """Only rows whose id comes more than once are compared, the null id's
    among them; with many such ids the result is the same."""
    ids = [1, 2, 3, 3, None, None, 4]
    rows = raw_df(spark, [{"case_id": i, "age": 50 - n} for n, i in enumerate(ids)]).withColumn(UP.SOURCE_COL, F.lit(1))
    want = [(None, 45), (1, 50), (2, 49), (3, 47), (4, 44)]
    for few in (UP.REPEATED, 1):
        monkeypatch.setattr(UP, "REPEATED", few)
        got = UP.first_rows(rows).select("case_id", "age").collect()
        assert sorted(map(tuple, got), key=lambda r: r[0] or 0) == want
    single = UP.first_rows(rows.where("case_id in (1, 2, 4)"))
    plan = single._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan and single.count() == 3
