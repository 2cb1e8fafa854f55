from pyspark.sql import functions as F

from epispark.config import Config
from epispark.operators import clean as CL
from helpers import raw_df

CFG = Config(year=2024)


def by_id(df, col):
    return {r["case_id"]: r[col] for r in df.select("case_id", col).collect()}


def test_scope_null_region_kept_null_year_dropped(spark):
    raw = raw_df(spark, [{"region_name": None}, {"epi_year": None}, {"region_name": "EXTERIOR"},
                         {"epi_year": 2023}, {}])
    out = CL.clean(raw, CFG)
    assert sorted(r["case_id"] for r in out.collect()) == [1, 5]


def test_region_alias_upper_trim(spark):
    raw = raw_df(spark, [{"region_name": " bogota d.c. "}, {"region_name": "norte de santander"},
                         {"region_name": "Huila"}])
    out = by_id(CL.clean(raw, CFG), "region_name")
    assert out == {1: "BOGOTÁ D.C.", 2: "NORTE SANTANDER", 3: "HUILA"}


def test_area_code_padding_and_override(spark):
    raw = raw_df(spark, [{"region_code": "5", "local_code": "1"},
                         {"region_code": "1234", "local_code": "1"},
                         {"region_name": "BOGOTA", "region_code": "11", "local_code": "999"},
                         {"local_code": None}])
    out = by_id(CL.clean(raw, CFG), "area_code")
    assert out == {1: "05001", 2: "1234001", 3: "11001", 4: None}


def test_dates_lenient_month_day_and_bad_text(spark):
    raw = raw_df(spark, [{"notified_text": "2024-1-5"}, {"notified_text": "2024-01-05 10:00"},
                         {"notified_text": "bad"}])
    out = by_id(CL.clean(raw, CFG), "notified_on")
    assert str(out[1]) == "2024-01-05" and out[2] is None and out[3] is None


def test_onset_check(spark):
    raw = raw_df(spark, [{"onset_text": "2024-03-06"},          # after notification
                         {"onset_text": "2023-03-05"},          # 366 days before
                         {"onset_text": "2023-03-06"},          # 365 days before: ok
                         {"onset_text": None},
                         {"notified_text": None}])
    out = CL.clean(raw, CFG)
    flag = by_id(out, "onset_corrected")
    onset = by_id(out, "onset_on")
    assert flag == {1: True, 2: True, 3: False, 4: False, 5: False}
    assert onset[1] is None and onset[2] is None and str(onset[3]) == "2023-03-06"


def test_age_inconsistency(spark):
    raw = raw_df(spark, [{"born_text": "2000-01-01", "age": 24},
                         {"born_text": "2000-01-01", "age": 30},
                         {"born_text": None, "age": 30}])
    assert by_id(CL.clean(raw, CFG), "age_inconsistent") == {1: False, 2: True, 3: False}


def test_text_fields(spark):
    raw = raw_df(spark, [{"group_name": "   ", "stratum": " "}, {"stratum": "3  "},
                         {"stratum": "2.5"}, {"stratum": "n/a"}])
    out = CL.clean(raw, CFG)
    assert by_id(out, "group_name")[1] == "Sin especificar"
    assert by_id(out, "stratum") == {1: None, 2: 3, 3: None, 4: None}


def test_dedup_full_rows_and_report(spark):
    rows = [{"case_id": 1}, {"case_id": 1}, {"case_id": 2, "region_name": "EXTERIOR"},
            {"case_id": 3, "epi_year": 2023}, {"case_id": 4}]
    raw = raw_df(spark, rows)
    rep = CL.clean_report(raw, CFG).first()
    assert rep["rows_in"] == 5 and rep["rows_dedup"] == 4 and rep["duplicates_removed"] == 1
    assert rep["excluded_non_territorial"] == 1 and rep["excluded_year"] == 1
    assert rep["excluded_total"] == 2 and rep["rows_out"] == 2


def test_clean_idempotent_on_typed_columns(spark):
    raw = raw_df(spark, [{}, {"sex": " m "}, {"region_name": "antioquia "}])
    once = CL.clean(raw, CFG)
    assert once.where(F.col("region_name") != "ANTIOQUIA").count() == 0
    assert by_id(once, "sex")[2] == "m" and by_id(once, "sex_label")[2] == "Otro/Ind."


def test_outliers_iqr_keeps_rows(spark):
    raw = raw_df(spark, [{"age": a} for a in (10, 20, 20, 21, 22, 23, 90)])
    c = CL.clean(raw, CFG)
    o = CL.age_outliers(c).first()
    assert o["q1"] == 20.0 and o["q3"] == 22.5 and o["n_outliers"] == 2
    assert c.count() == 7


def test_all_years_config(spark):
    from epispark.operators import validate as VA
    cfg = Config(year=None)
    raw = raw_df(spark, [{"epi_year": 2023}, {"epi_year": 2024}, {"epi_year": None},
                         {"region_name": "EXTERIOR"}])
    assert sorted(r["case_id"] for r in CL.clean(raw, cfg).collect()) == [1, 2, 3]
    rep = CL.clean_report(raw, cfg).first()
    assert rep["excluded_year"] == 0 and rep["excluded_total"] == 1 and rep["rows_out"] == 3
    f = {r["rule_id"]: r for r in VA.findings(raw, cfg).collect()}
    assert not f["year"]["triggered"] and not f["date_year"]["triggered"]


def test_stratum_out_of_int_range_is_null(spark):
    raw = raw_df(spark, [{"stratum": "1e20"}, {"stratum": "4"}])
    assert by_id(CL.clean(raw, CFG), "stratum") == {1: None, 2: 4}


def test_dedup_can_be_skipped_for_clean_feeds(spark):
    raw = raw_df(spark, [{"case_id": 1}, {"case_id": 1}, {"case_id": 2}])
    assert CL.clean(raw, CFG).count() == 2
    assert CL.clean(raw, CFG.with_(dedup_full_rows=False)).count() == 3
    plan = CL.clean(raw, CFG.with_(dedup_full_rows=False))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_codes_with_several_names(spark):
    from epispark.operators import profile as PF
    raw = raw_df(spark, [{"local_name": "MEDELLIN"}, {"local_name": "MEDELLÍN"},
                         {"local_code": "002", "local_name": "BELLO"}])
    r = PF.codes_with_several_names(CL.clean(raw, CFG)).collect()
    assert len(r) == 1 and r[0]["area_code"] == "05001" and r[0]["n_names"] == 2


def test_rows_are_deduplicated_by_digest(spark):
    """Nulls are equal to nulls alone; unique rows are not shuffled in full."""
    rows = [(1, None, "a"), (1, "a", None), (1, None, "a"), (2, "", "b"), (2, None, "b"), (3, "x", "y"), (3, "x", "y"), (3, "x", "y")]
    df = spark.createDataFrame(rows, "i int, s string, t string").repartition(4)
    out = CL.dedup_rows(df)
    assert sorted(map(repr, out.collect())) == sorted({repr(r) for r in df.collect()})
    wide = spark.range(2000).union(spark.range(5)).selectExpr("id", "repeat(cast(id as string), 50) as text")
    plan = CL.dedup_rows(wide)
    assert len(plan.collect()) == 2000
    text = plan._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    unique = text.split("Union", 1)[1].split("BroadcastHashJoin", 1)
    assert len(unique) == 2 and "Exchange" not in unique[0]         # the unique rows meet a broadcast


def test_unique_rows_are_read_once_more_and_not_shuffled(spark, tmp_dir, monkeypatch):
    """Without copies the clean table is one scan without a shuffle; few and
    many copies give the same rows."""
    rows = [{"case_id": i, "age": 20 + i % 9} for i in range(40)]
    raw_df(spark, rows).write.parquet(f"{tmp_dir}/raw")
    clean = CL.clean(spark.read.parquet(f"{tmp_dir}/raw"), CFG)
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Exchange" not in plan
    want = sorted(map(repr, clean.collect()))
    copied = raw_df(spark, rows + rows[:7])
    for few in (CL.REPEATED, 3):
        monkeypatch.setattr(CL, "REPEATED", few)
        assert sorted(map(repr, CL.clean(copied, CFG).collect())) == want
