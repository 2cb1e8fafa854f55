import random

import numpy as np
import pytest
from epispark.operators import quantiles as Q
from pyspark.sql import functions as F


def check(spark, values, probs=(0.0, 0.25, 0.5, 0.9, 1.0)):
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(3)
    got = Q.quantiles_by(df, "v", probs).first()["q"]
    want = df.select(F.percentile("v", F.array(*[F.lit(float(p)) for p in probs]))).first()[0]
    assert got == want, (got, want)


@pytest.mark.parametrize("small", [1, 50])
def test_selection_equals_percentile(spark, monkeypatch, small):
    """Ranges of at most ``SMALL`` rows are sorted; a small bound forces the passes before."""
    monkeypatch.setattr(Q, "SMALL", small)
    monkeypatch.setattr(Q, "BINS", 8)
    rng = random.Random(small)
    check(spark, [rng.randrange(95) for _ in range(700)])
    check(spark, [rng.gauss(0, 1) for _ in range(300)])
    check(spark, [rng.choice([-1, 1]) * 10 ** rng.uniform(-12, 12) for _ in range(300)])
    check(spark, [0.0, -0.0, 1e300, -1e300, 5e-324, 3.0, 3.0, 3.0])
    check(spark, [7.0] * 40)


def test_first_bins_never_fall(spark):
    rng = random.Random(5)
    xs = [s * (b + d) for s in (-1, 1) for b in (0, 1, 2047, 2048, 2049, 4096, 1e9) for d in (0, 0.25, 0.5, 1e-9)]
    xs += [rng.choice([-1, 1]) * 10 ** rng.uniform(-20, 300) for _ in range(2000)]
    xs += [float("inf"), float("-inf"), 1.7976931348623157e308, 5e-324, float("nan")]
    df = spark.createDataFrame([(float(v),) for v in xs], "x double")
    bins = [r.b for r in df.select("x", Q.first_bin(F.col("x")).alias("b")).orderBy("x").collect()]
    assert bins == sorted(bins) and max(bins[:-1]) < bins[-1]
    whole = spark.range(-2048, 2049).select(Q.first_bin(F.col("id").cast("double")).alias("b"), "id")
    assert whole.where("b != id").isEmpty()


def test_whole_numbers_take_one_pass(spark, monkeypatch):
    monkeypatch.setattr(Q, "order_statistics", None)        # the later passes
    check(spark, [random.Random(2).randrange(-20, 2000) for _ in range(500)])


@pytest.mark.parametrize("small", [1, 10_000])
def test_weights_stand_for_rows(spark, monkeypatch, small):
    monkeypatch.setattr(Q, "SMALL", small)
    rng = random.Random(small)
    rows = [(rng.choice("ab"), rng.choice([0.25, 0.5, 0.75, 3.0, 40.5, 1e6, 1e6 + 1]), rng.choice([None, 0, 1, 5, 900])) for _ in range(80)]
    df = spark.createDataFrame(rows, "g string, v double, n bigint")
    probs = (0.0, 0.3, 0.5, 0.99, 1.0)
    got = {r["g"]: r["q"] for r in Q.quantiles_by(df, "v", probs, ["g"], weight="n").collect()}
    each = df.where("n > 0").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    want = {r["g"]: r["q"] for r in each.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("q")).collect()}
    assert got == want
    assert Q.quantiles_by(df.where("n = 0"), "v", probs, weight="n").collect() == []


def test_infinite_values(spark):
    check(spark, [float("inf")] * 3 + [1.5, 2.5, 3e9, 4e9] + [float("-inf")], probs=(0.0, 1.0))
    df = spark.createDataFrame([(float("inf"),), (1.0,), (2.0,)], "v double")
    assert Q.quantiles_by(df, "v", (0.5,)).first()["q"] == [2.0]


def test_groups_with_null_keys_and_values(spark):
    rows = [("a", 1.0), ("a", 4.0), ("a", None), (None, 2.0), (None, 3.0), ("", 9.0), ("b", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r["q"] for r in Q.quantiles_by(df, "v", (0.5,), ["g"]).collect()}
    assert got == {"a": [2.5], None: [2.5], "": [9.0]}


@pytest.mark.parametrize("small", [1, 10_000])
def test_keys_of_any_type(spark, monkeypatch, small):
    monkeypatch.setattr(Q, "SMALL", small)
    rows = [(d, b, v / 7) for d in ("2024-01-01", "1970-01-01", None) for b in (True, None) for v in range(len(d or "x") * 3)]
    df = spark.createDataFrame(rows, "d string, b boolean, v double").select(
        F.col("d").cast("date").alias("d"), "b", F.col("v").cast("decimal(9,4)").alias("m"), "v")
    got = {(r["d"], r["b"]): r["q"] for r in Q.quantiles_by(df, "v", (0.25, 0.5), ["d", "b"]).collect()}
    want = {(r["d"], r["b"]): r["q"] for r in df.groupBy("d", "b").agg(
        F.percentile("v", F.array(F.lit(0.25), F.lit(0.5))).alias("q")).collect()}
    assert got == want and len(got) == 6
    assert Q.quantiles_by(df, "v", (0.5,), ["m"]).count() == df.select("m").distinct().count()


def test_empty(spark):
    df = spark.createDataFrame([], "v double")
    assert Q.quantiles_by(df, "v", (0.5,)).collect() == []
    from epispark.operators import charts
    assert charts.center_lines(df, "v").first()["median"] is None


def test_no_percentile_map_in_the_plans(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(float(x),) for x in rng.random(500)], "v double")
    from epispark.operators import clean
    plan = clean.age_outliers(df, "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan
