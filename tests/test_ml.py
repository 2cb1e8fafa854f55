import pytest

from epispark.config import Config
from epispark.operators import ml as ML
from epispark.plans import catalog
from conftest import SF_SMALL

CFG = Config(year=1998)


@pytest.fixture(scope="module")
def idx(spark):
    return catalog.inputs(spark, SF_SMALL).index


def test_metrics_on_fixed_predictions(spark):
    pred = spark.createDataFrame(
        [("Baja", "Baja"), ("Baja", "Media"), ("Media", "Media"), ("Alta", "Baja")],
        "priority string, predicted_priority string")
    m = {r["priority"]: r for r in ML.metrics(pred).collect()}
    assert m["Baja"]["precision"] == 0.5 and m["Baja"]["recall"] == 0.5
    assert m["Media"]["precision"] == 0.5 and m["Media"]["recall"] == 1.0
    assert m["Alta"]["f1"] == 0.0 and m["Crítica"]["support"] == 0
    assert m["Baja"]["accuracy"] == 0.5


def test_confusion_fixed(spark):
    pred = spark.createDataFrame([("Baja", "Baja"), ("Baja", "Media")],
                                 "priority string, predicted_priority string")
    c = {r["priority"]: r for r in ML.confusion(pred).collect()}
    assert c["Baja"]["pred_4"] == 1 and c["Baja"]["pred_3"] == 1 and c["Alta"]["pred_1"] == 0


def test_prepare_split_weights(idx):
    p = ML.prepare(idx, CFG)
    assert set(r["priority"] for r in p.select("priority").distinct().collect()) <= {
        "Baja", "Media", "Alta", "Crítica"}
    s = ML.split(p, 0.2, 42)
    n, t = s.count(), s.where("is_test").count()
    assert 0 < t < n
    w = ML.with_class_weight(p).select("label", "weight").distinct().collect()
    assert all(r["weight"] > 0 for r in w)
    assert ML.split(p, 0.2, 42).where("is_test").select("area_code").collect() == \
        s.where("is_test").select("area_code").collect()


def test_forest_importances_sum_to_one(idx):
    imp = [r["importance"] for r in ML.importances(idx, CFG).collect()]
    assert len(imp) == len(CFG.model_features) and abs(sum(imp) - 1.0) < 1e-9


def test_standardize_zero_mean(idx):
    z = ML.standardize(idx, CFG)
    from pyspark.sql import functions as F
    means = z.agg(*[F.avg(f"{c}_z").alias(c) for c in CFG.model_features]).first()
    assert all(abs(means[c]) < 1e-9 for c in CFG.model_features)


def test_kmeans_labels_by_rate(idx):
    k = ML.kmeans(idx, CFG, n_init=2)
    prof = sorted(ML.cluster_profile(k, CFG).collect(), key=lambda r: r["cluster"])
    rates = [r["rate_100k"] for r in prof]
    assert rates == sorted(rates)
    assert prof[0]["cluster_label"] == "Cluster 0"


def test_elbow_cost_non_increasing(idx):
    e = sorted(ML.elbow(idx, CFG, ks=range(2, 5), n_init=3).collect(), key=lambda r: r["k"])
    costs = [r["inertia"] for r in e]
    assert all(b <= a * 1.05 for a, b in zip(costs, costs[1:]))


def _balanced(spark, n=60):
    """Areas in three classes of equal size that one feature tells apart."""
    rows = []
    for i in range(n):
        k = i % 3
        rows.append((f"{i:05d}", f"R{i % 4}", f"L{i}", 50, ("Baja", "Media", "Alta")[k],
                     *[float(10 + k * 10 + (i * 7 + j) % 5) for j in range(len(CFG.model_features))]))
    return spark.createDataFrame(rows, ["area_code", "region_name", "local_name", "cases", "priority", *CFG.model_features]) \
        if "cases" not in CFG.model_features else spark.createDataFrame(
            [r[:3] + r[4:] for r in rows], ["area_code", "region_name", "local_name", "priority", *CFG.model_features])


def test_cross_validation_runs_its_folds(spark):
    df = _balanced(spark)
    r = ML.cross_validate(df, CFG, 3).first()
    assert r["folds"] == 3 and r["mean_accuracy"] > 0.9 and 0 <= r["std_accuracy"] < 0.2
    rules = ML.tree_rules(df, CFG).collect()
    assert len(rules) >= 5 and any("Predict" in x["rule"] for x in rules)


def test_split_takes_the_smallest_hashes_of_each_class(spark):
    import hashlib
    got = ML.split(ML.prepare(_balanced(spark), CFG, 0), 0.2, 42).collect()
    want = set()
    for label in {r["label"] for r in got}:
        own = sorted((hashlib.md5(f"{r['area_code']}:42".encode()).hexdigest()[:15], r["area_code"]) for r in got if r["label"] == label)
        want |= {a for _, a in own[:-(-len(own) // 5)]}
    assert {r["area_code"] for r in got if r["is_test"]} == want and len(got) == 60


def test_folds_are_even_within_classes(spark):
    from pyspark.sql import functions as F
    p = ML.prepare(_balanced(spark), CFG, 0)
    ranked, sizes = ML.hash_rank(p, "label", 42)
    assert {r["_size"] for r in sizes.collect()} == {20}
    for label in (0.0, 1.0, 2.0):
        assert sorted(r["_place"] for r in ranked.where(F.col("label") == label).collect()) == list(range(20))


def test_folds_partition_the_training_areas(spark):
    df = _balanced(spark)
    dealt, k = ML.folds(df, CFG, 4)
    got = dealt.collect()
    assert k == 4 and len(got) == 48 and not {"_place", "is_test"} & set(dealt.columns)
    sizes = {}
    for r in got:
        sizes[r["priority"], r["fold"]] = sizes.get((r["priority"], r["fold"]), 0) + 1
    assert set(sizes.values()) == {4} and len(sizes) == 12
    few, none = ML.folds(df.where("priority = 'Baja'").limit(1), CFG, 4)
    assert none == 0 and few.count() <= 1


def test_baseline_takes_the_class_of_its_region(spark):
    df = _balanced(spark)
    split = {r["area_code"]: r for r in ML.split(ML.prepare(df, CFG, 0), 0.2, CFG.seed).collect()}
    got = ML.baseline_predictions(df, CFG).collect()
    assert len(got) == 12
    for r in got:
        seen = [x["priority"] for x in split.values() if not x["is_test"] and x["region_name"] == r["region_name"]]
        best = min(set(seen), key=lambda c: (-seen.count(c), c))
        assert r["predicted_priority"] == best
    assert ML.metrics(ML.baseline_predictions(df, CFG)).count() == 4


def test_model_table_partitions_follow_its_size(spark, monkeypatch):
    df = spark.range(0, 100, 1, 8)
    assert ML.model_table(df).rdd.getNumPartitions() == 1
    monkeypatch.setattr(ML, "ROWS_PER_TASK", 30)
    assert ML.model_table(df).rdd.getNumPartitions() == 4 and ML.model_table(df.limit(0)).count() == 0
