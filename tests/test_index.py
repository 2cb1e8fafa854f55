from pyspark.sql import functions as F

from epispark.config import Config
from epispark.operators import clean as CL
from epispark.operators import index as IX
from helpers import raw_df

CFG = Config(year=2024)


def areas_of(spark, rows, pop_rows):
    raw = raw_df(spark, rows)
    pop = spark.createDataFrame(pop_rows, "area_code string, population double")
    return IX.area_base(CL.clean(raw, CFG), pop, CFG, checkpoint=False)


def test_trend_h1_zero_and_null_week(spark):
    rows = [{"local_code": "001", "epi_week": 30}, {"local_code": "002", "epi_week": 10},
            {"local_code": "002", "epi_week": 40}, {"local_code": "002", "epi_week": 41},
            {"local_code": "002", "epi_week": None}, {"local_code": "002", "epi_week": 45},
            {"local_code": "002", "epi_week": 46}]
    a = {r["area_code"]: r for r in areas_of(spark, rows, [("05001", 1000.0)]).collect()}
    assert a["05001"]["cases_h1"] == 0 and a["05001"]["trend"] == 1.0
    # null week counts in the first half for the index: H1 = 2, H2 = 4 -> 1.0 (clamped)
    assert a["05002"]["cases_h1"] == 2 and a["05002"]["cases_h2"] == 4
    assert a["05002"]["trend"] == 1.0


def test_population_imputation(spark):
    rows = [{"local_code": "001"}, {"local_code": "002"}, {"local_code": "003"},
            {"region_code": "08", "region_name": "ATLANTICO", "local_code": "001"}]
    pop = [("05001", 1001.0), ("05002", 2000.0)]
    a = {r["area_code"]: r["population"] for r in areas_of(spark, rows, pop).collect()}
    assert a["05003"] == 1500.0                 # region mean 1500.5 rounded half-even
    assert a["08001"] == 50000.0                # nothing known in the region -> default


def test_minmax_constant_column_and_score_range(spark):
    rows = [{"local_code": f"00{i}", "age": 14 if i % 2 else 30} for i in range(1, 6)]
    areas = areas_of(spark, rows, [])
    idx = IX.priority_index(areas, CFG)
    r = idx.collect()
    assert all(x["pct_psychiatric_norm"] == 0.0 for x in r)           # constant -> 0
    assert all(0.0 <= x["score"] <= 100.0 for x in r)
    assert min(x["rank"] for x in r) == 1


def test_rank_min_method_ties(spark):
    df = spark.createDataFrame([(1, 50.0), (2, 70.0), (3, 50.0), (4, 10.0)], "id int, score double")
    got = {r["id"]: r["rank"] for r in IX.with_rank(df).collect()}
    assert got == {2: 1, 1: 2, 3: 2, 4: 4}


def test_classes_monotone_and_distribution(spark):
    df = spark.createDataFrame([(i, float(s)) for i, s in enumerate([10, 45, 65, 85, 39.99])],
                               "id int, score double")
    from epispark.functions import derive as D
    idx = df.withColumn("priority", D.classify("score"))
    dist = {r["priority"]: r["areas"] for r in IX.priority_distribution(idx).collect()}
    assert dist == {"Crítica": 1, "Alta": 1, "Media": 1, "Baja": 2}


def test_emerging_filters(spark):
    df = spark.createDataFrame(
        [("a", 0.9, "Media", 10, 50.0), ("b", 0.9, "Crítica", 10, 90.0),
         ("c", 0.4, "Baja", 10, 20.0), ("d", 1.0, "Baja", 4, 20.0)],
        "area_code string, trend double, priority string, cases int, score double") \
        .withColumn("region_name", F.lit("R")).withColumn("local_name", F.lit("L"))
    assert [r["area_code"] for r in IX.emerging(df, CFG, 10).collect()] == ["a"]


def test_zero_population_gives_null_rate(spark):
    rows = [{"local_code": "001"}, {"local_code": "002"}]
    a = {r["area_code"]: r for r in areas_of(spark, rows, [("05001", 0.0),
                                                           ("05002", 1000.0)]).collect()}
    assert a["05001"]["rate_100k"] is None and a["05002"]["rate_100k"] == 100.0
