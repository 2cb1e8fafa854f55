import numpy as np
from pyspark.sql import functions as F

from epispark.config import Config
from epispark.operators import charts as CH
from epispark.operators import clean as CL
from epispark.operators import crosstab as XT
from epispark.operators import describe as DS
from epispark.operators import windows as WN
from helpers import raw_df

CFG = Config(year=2024)


def clean_of(spark, rows):
    return CL.clean(raw_df(spark, rows), CFG)


def test_cube_totals_equal_cell_sums(spark):
    rows = [{"age": a, "sex": s} for a, s in [(5, "F"), (15, "M"), (15, "F"), (30, "F"),
                                               (0, "F"), (70, "X")]]
    t = XT.age_by_sex(clean_of(spark, rows)).collect()
    cells = [r for r in t if r["grouping_id"] == 0]
    grand = [r for r in t if r["grouping_id"] == 3][0]
    assert grand["cases"] == sum(r["cases"] for r in cells) == 5      # age 0 has no group
    row_tot = {r["age_group"]: r["cases"] for r in t if r["grouping_id"] == 1}
    assert row_tot["12–17"] == 2


def test_kpis_modes_and_shares(spark):
    rows = [{"sex": "F", "region_name": "B"}, {"sex": "M", "region_name": "A"},
            {"sex": None, "region_name": "A"}, {"sex": "F", "region_name": "B"}]
    k = DS.kpis(clean_of(spark, rows)).first()
    assert k["total_cases"] == 4 and k["pct_female"] == 50.0 and k["pct_male"] == 25.0
    assert k["top_region"] == "A"                   # tie 2-2 -> smallest name
    assert k["regions"] == 2


def test_kpis_filtered_empty(spark):
    c = clean_of(spark, [{}])
    k = DS.kpis_filtered(DS.filter_cases(c, region="NOWHERE")).first()
    assert k["total_cases"] == 0 and k["pct_adolescent"] == 0.0 and k["top_region"] == "–"


def test_weekly_trend_trailing_rows(spark):
    rows = [{"epi_week": w} for w in (1, 1, 2, 5, 5, 5, 6)]
    t = {r["epi_week"]: r["moving_avg"] for r in WN.weekly_trend(clean_of(spark, rows)).collect()}
    assert t == {1: 2.0, 2: 1.5, 5: 2.0, 6: 1.8}     # missing weeks skipped, min_periods=1


def test_histogram_matches_numpy(spark):
    ages = [0, 1, 5, 5, 17, 22, 33, 47, 60, 94, 94, 13, 71]
    c = clean_of(spark, [{"age": a} for a in ages])
    h = sorted((r["bin"], r["cases"]) for r in CH.histogram(c, "age", 30).collect())
    counts, _ = np.histogram(np.array(ages, dtype=float), bins=30)
    assert [n for _, n in h] == counts.tolist()


def test_boxplot_matches_numpy(spark):
    ages = [10, 20, 20, 21, 22, 23, 90, 25]
    c = clean_of(spark, [{"age": a, "sex": "F"} for a in ages])
    b = CH.boxplot(c).first()
    q1, med, q3 = np.percentile(ages, [25, 50, 75])
    assert (b["q1"], b["median"], b["q3"]) == (q1, med, q3)
    assert b["outliers"] == 2 and b["whisker_hi"] == 25.0


def test_risk_groups_single_pass(spark):
    rows = [{"gp_psychiatric": 1}, {"gp_psychiatric": 2}, {"gp_psychiatric": None}]
    r = DS.risk_groups(clean_of(spark, rows)).first()
    assert r["group"] == "gp_psychiatric" and r["cases"] == 1 and r["pct"] == 33.33


def test_month_by_sex_zero_filled(spark):
    rows = [{"notified_text": "2024-01-05", "sex": "F"}, {"notified_text": "2024-02-05",
                                                         "sex": "M"}]
    t = {r["month"]: r for r in XT.month_by_sex(clean_of(spark, rows)).collect()}
    assert t[1]["n_female"] == 1 and t[1]["n_male"] == 0 and t[2]["month_name"] == "Feb"


def test_semester_change(spark):
    rows = [{"epi_week": 5}, {"epi_week": 30}, {"epi_week": 31}, {"epi_week": None}]
    s = DS.semester_change(clean_of(spark, rows)).first()
    assert (s["cases_h1"], s["cases_h2"], s["pct_change"]) == (1, 3, 200.0)
    assert F is not None
