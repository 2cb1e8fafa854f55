from pyspark.sql import functions as F

from epispark.config import Config
from epispark.operators import validate as VA
from helpers import raw_df


def findings(df, year=2024):
    return {r["rule_id"]: r for r in VA.findings(df, Config(year=year)).collect()}


def values(df, year=2024):
    out = {}
    for r in VA.offending_values(df, Config(year=year)).collect():
        out.setdefault(r["rule_id"], {})[r["value"]] = r["value_rows"]
    return out


def test_every_offending_value_is_listed(spark):
    raw = raw_df(spark, [{"sex": f"S{i:03d}"} for i in range(60)] + [{"sex": "S001"}, {"sex": "\tF"}, {"sex": "\u00a0m "}])
    assert values(raw)["sex_domain"] == {f"S{i:03d}": 2 if i == 1 else 1 for i in range(60)}
    assert findings(raw)["sex_domain"]["n_rows"] == 61               # padded F and m pass


def test_one_rule_alone_gives_the_same_row(spark):
    raw = raw_df(spark, [{"sex": "X"}, {"age": 130}, {"epi_year": 2023}])
    whole = VA.findings(raw, Config(year=2024)).collect()
    for r in whole:
        assert VA.findings(raw, Config(year=2024), [r["rule_id"]]).collect() == [r]
    plan = VA.findings(raw, Config(year=2024))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_domain_rules(spark):
    raw = raw_df(spark, [{"sex": "f"}, {"sex": "X"}, {"sex": None}, {"area_type": 4},
                         {"hospital_code": 3}, {"epi_year": 2023}, {"region_code": "5"},
                         {"local_code": "1"}, {"notified_text": "bad"}, {"age": 130}])
    f = findings(raw)
    v = values(raw)
    assert f["sex_domain"]["triggered"] and v["sex_domain"] == {"X": 1}
    assert f["sex_domain"]["n_rows"] == 1                    # 'f' passes after upper-casing
    assert v["area_domain"] == {"4": 1} and v["hospital_domain"] == {"3": 1}
    assert v["year"] == {"2023": 1} and f["year"]["n_rows"] == 1
    assert f["short_region_code"]["n_rows"] == 1 and f["short_local_code"]["n_rows"] == 1
    assert f["date_format"]["n_rows"] == 1 and f["age_range"]["n_rows"] == 1
    assert not f["event_code"]["triggered"]
    s = VA.summary(raw, VA.findings(raw, Config(year=2024))).first()
    assert s["is_valid"] is False and s["rows"] == 10


def test_missing_required_columns_stop(spark):
    raw = raw_df(spark, [{}]).drop("sex")
    f = findings(raw)
    assert f["required_columns"]["triggered"] and f["required_columns"]["vals"] == ["sex"]
    assert "sex_domain" not in f


def test_missing_psychiatric_flag_warns(spark):
    f = findings(raw_df(spark, [{}]).drop("gp_psychiatric"))
    assert f["psychiatric_flag_missing"]["triggered"]
    assert not findings(raw_df(spark, [{}]))["psychiatric_flag_missing"]["triggered"]


def test_empty_columns(spark):
    raw = raw_df(spark, [{}, {}]).withColumn("group_name", F.lit(None).cast("string")) \
        .withColumn("age", F.lit(None).cast("int"))
    f = findings(raw)
    assert f["empty_required"]["vals"] == ["age"] and f["empty_other"]["vals"] == ["group_name"]


def test_contract_doc_lists_columns():
    doc = VA.contract_doc()
    assert "`case_id`" in doc and "`gp_psychiatric`" in doc


def test_huge_codes_do_not_fail(spark):
    raw = raw_df(spark, [{}]).withColumn("area_type", F.lit("1e30"))
    f = findings(raw)
    assert f["area_domain"]["triggered"] and values(raw)["area_domain"] == {"1.0E30": 1}


def test_every_rule_fires_on_files_full_of_faults(spark):
    bad = [{"sex": "\tq "}, {"area_type": 9}, {"hospital_code": 7}, {"epi_year": 1999}, {"region_code": " 5"},
           {"local_code": "1 "}, {"notified_text": "soon"}, {"notified_text": "1999-01-02"}, {"age": 300}]
    raw = raw_df(spark, bad).withColumn("event_code", F.lit(1)).withColumn("group_name", F.lit(None).cast("string")) \
        .withColumn("event_name", F.lit(None).cast("string")).withColumn("age", F.col("age").cast("string")) \
        .drop("gp_psychiatric")
    raw = raw.unionByName(raw.limit(1).withColumn("age", F.lit("old")))
    fired = {r["rule_id"] for r in VA.findings(raw, Config(year=2024, max_rows=5)).collect() if r["triggered"]}
    fired |= {r["rule_id"] for r in VA.findings(raw.drop("sex").limit(0), Config(year=2024)).collect() if r["triggered"]}
    assert fired == set(VA.MESSAGES)
    assert set(values(raw)) == set(VA.VALUE_RULES)
