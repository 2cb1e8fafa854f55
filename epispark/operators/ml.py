"""Area-level models with Spark ML: decision tree, random forest, k-fold
accuracy, per-class metrics, z-scored k-means with an elbow scan.

The model table is at area grain (one row per area, bounded by geography,
not by case volume); it is rebuilt from the index and fed to Spark ML as a
``VectorAssembler`` column.  Splits and folds are deterministic functions of
the area code (its MD5 with the seed), so they do not depend on partitioning.
A fit runs many short jobs over its table; ``model_table`` writes that once,
in as few partitions as its size asks for.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import Config
from ..functions.core import round_half_even
from ..session import materialize

KEYS = ("area_code", "region_name", "local_name")
ROWS_PER_TASK = 50_000      # areas in a partition of a table that models are fitted from


def model_table(df: DataFrame) -> DataFrame:
    """``df`` checkpointed, in partitions of about ``ROWS_PER_TASK`` rows."""
    kept = materialize(df)
    return kept.coalesce(max(1, -(-kept.count() // ROWS_PER_TASK)))


def prepare(idx: DataFrame, cfg: Config | None = None, min_cases: int | None = None,
            target: str = C.MODEL_TARGET) -> DataFrame:
    """Areas with at least ``min_cases`` cases, features null -> 0, target
    indexed in alphabetical class order."""
    cfg = cfg or Config()
    m = cfg.min_cases if min_cases is None else min_cases
    f = idx.where(F.col("cases") >= m) if m else idx
    feats = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
             for c in cfg.model_features]
    df = f.select(*KEYS, *feats, F.col(target).alias("priority"))
    indexer = StringIndexer(inputCol="priority", outputCol="label",
                            stringOrderType="alphabetAsc").fit(df)
    return indexer.transform(df)


def class_counts(prepared: DataFrame) -> DataFrame:
    return prepared.groupBy("priority", "label").agg(F.count(F.lit(1)).alias("n"))


def assemble(df: DataFrame, cfg: Config | None = None) -> DataFrame:
    cfg = cfg or Config()
    return VectorAssembler(inputCols=list(cfg.model_features), outputCol="features") \
        .transform(df)


def split(prepared: DataFrame, test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_test``: within each class (when the smallest class has >= 2
    areas, else globally) the ceil(fraction * n) areas with the smallest
    ``split_hash`` form the test set."""
    sizes = {r["label"]: r["n"] for r in class_counts(prepared).select("label", "n").collect()}   # a row per class
    group = F.col("label") if sizes and min(sizes.values()) >= 2 else F.lit(0.0)
    ranked, counts = hash_rank(prepared.withColumn("_group", group), "_group", seed)
    return (ranked.join(counts, "_group")
            .withColumn("is_test", F.col("_place") < F.ceil(F.col("_size") * test_fraction))
            .drop("_group", "_place", "_size"))


def split_hash(seed: int) -> F.Column:
    """60 bits of the MD5 of area code and seed: any engine can compute it."""
    text = F.concat(F.coalesce(F.col("area_code"), F.lit("")), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def hash_rank(df: DataFrame, group: str, seed: int) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``_place``, a row's place (from 0) in its group by the hash
    of its area code, and the groups' sizes (group, _size).  The hash range is
    cut into bins: a row's place is its place in its bin after all rows of
    lower bins, so no task sorts a whole group."""
    binned = df.withColumn("_hash", split_hash(seed)).withColumn("_bin", F.shiftright("_hash", 52).cast("int"))   # 0 .. 255, in the order of the hash
    counts = binned.groupBy(group, "_bin").agg(F.count(F.lit(1)).alias("_n"))          # 256 rows a group, at most
    before = counts.select(group, "_bin", (F.sum("_n").over(
        Window.partitionBy(group).orderBy("_bin")) - F.col("_n")).alias("_before"))
    local = F.row_number().over(Window.partitionBy(group, "_bin").orderBy("_hash", *KEYS)) - 1
    ranked = (binned.join(before, [group, "_bin"]).withColumn("_place", F.col("_before") + local)
              .drop("_bin", "_hash", "_before"))
    return ranked, counts.groupBy(group).agg(F.sum("_n").alias("_size"))


def with_class_weight(df: DataFrame, on: DataFrame | None = None) -> DataFrame:
    """Balanced weights n / (k * n_c), from the class counts of ``on``."""
    on = df if on is None else on
    counts = on.groupBy("label").agg(F.count(F.lit(1)).alias("_nc"))
    tot = counts.select(F.struct(F.sum("_nc").alias("n"), F.count(F.lit(1)).alias("k"))) \
                .scalar()
    w = counts.select("label", (tot["n"] / (tot["k"] * F.col("_nc"))).alias("weight"))
    return df.join(F.broadcast(w), "label", "left").fillna(0.0, subset=["weight"])


def _train_test(prepared: DataFrame, cfg: Config):
    s = model_table(assemble(split(prepared, 0.2, cfg.seed), cfg))
    return model_table(with_class_weight(s.where(~F.col("is_test")))), s.where(F.col("is_test"))


def fit_tree(train: DataFrame, seed: int = 42, max_depth: int = 5):
    return DecisionTreeClassifier(featuresCol="features", labelCol="label",
                                  weightCol="weight", maxDepth=max_depth,
                                  impurity="gini", seed=seed).fit(train)


def fit_forest(train: DataFrame, seed: int = 42, num_trees: int = 100, max_depth: int = 8):
    return RandomForestClassifier(featuresCol="features", labelCol="label",
                                  weightCol="weight", numTrees=num_trees,
                                  maxDepth=max_depth, impurity="gini", seed=seed).fit(train)


def predictions(model, test: DataFrame, prepared: DataFrame) -> DataFrame:
    """Test-set predictions with the predicted class name (label index ->
    class via the indexed pairs, at most one row per class: broadcast)."""
    p = model.transform(test)
    names = prepared.select(F.col("label").alias("prediction"),
                            F.col("priority").alias("predicted_priority")).distinct()
    return p.select(*KEYS, "priority", "label", "prediction") \
            .join(F.broadcast(names), "prediction", "left")


def tree_predictions(idx: DataFrame, cfg: Config | None = None) -> DataFrame:
    cfg = cfg or Config()
    prepared = prepare(idx, cfg)
    train, test = _train_test(prepared, cfg)
    return predictions(fit_tree(train, cfg.seed), test, prepared)


def forest_predictions(idx: DataFrame, cfg: Config | None = None) -> DataFrame:
    cfg = cfg or Config()
    prepared = prepare(idx, cfg)
    train, test = _train_test(prepared, cfg)
    return predictions(fit_forest(train, cfg.seed), test, prepared)


def tree_rules(idx: DataFrame, cfg: Config | None = None, max_depth: int | None = None
               ) -> DataFrame:
    """The fitted tree as text rows (line number, depth, rule text), optionally
    only the rules down to ``max_depth`` (the model text is driver-side model
    metadata, not data)."""
    cfg = cfg or Config()
    train, _ = _train_test(prepare(idx, cfg), cfg)
    model = fit_tree(train, cfg.seed)
    names = list(cfg.model_features)
    text = model.toDebugString
    for i, n in enumerate(names):
        text = text.replace(f"feature {i} ", f"{n} ")
    rows = []
    for ln in text.splitlines()[1:]:                   # first line: model summary
        if not ln.strip():
            continue
        depth = (len(ln) - len(ln.lstrip(" "))) - 1
        if max_depth is None or depth <= max_depth:
            rows.append((len(rows) + 1, depth, ln.strip()))
    spark = idx.sparkSession
    return spark.createDataFrame(rows, "line int, depth int, rule string")


def importances(idx: DataFrame, cfg: Config | None = None, labels: dict[str, str] | None = None) -> DataFrame:
    """Normalised Gini importances of the forest, sorted, with an above-mean
    flag and the caller's labels (else the names)."""
    cfg = cfg or Config()
    train, _ = _train_test(prepare(idx, cfg), cfg)
    model = fit_forest(train, cfg.seed)
    vals = model.featureImportances.toArray().tolist()
    spark = idx.sparkSession
    df = spark.createDataFrame(list(zip(cfg.model_features, vals)),
                               "feature string, importance double")
    mean = 1.0 / len(vals) if vals else 0.0
    label = F.col("feature")
    for k, v in (labels or {}).items():
        label = F.when(F.col("feature") == k, F.lit(v)).otherwise(label)
    return df.select("feature", label.alias("label"), "importance",
                     (F.col("importance") > mean).alias("above_mean")) \
             .orderBy(F.col("importance").desc(), "feature")


def folds(idx: DataFrame, cfg: Config | None = None, max_folds: int = 5) -> tuple[DataFrame, int]:
    """The training areas with their fold, and the number of folds k = min(5,
    smallest class), 0 where that is under 2 (then all are of fold 0).  A row's
    fold is its place within its class by area hash, mod k."""
    cfg = cfg or Config()
    s = model_table(split(prepare(idx, cfg), 0.2, cfg.seed).where(~F.col("is_test")))
    sizes = [r["count"] for r in s.groupBy("label").count().collect()]              # a row per class
    k = min(max_folds, *sizes) if sizes and min(sizes) >= 2 else 0
    ranked, _ = hash_rank(s, "label", cfg.seed)
    return ranked.withColumn("fold", (F.col("_place") % max(k, 1)).cast("int")).drop("_place", "is_test"), k


def cross_validate(idx: DataFrame, cfg: Config | None = None, max_folds: int = 5) -> DataFrame:
    """Accuracy of the forest over the ``folds`` of the training areas; skipped
    (0 folds, null scores) where there are none."""
    cfg = cfg or Config()
    dealt, k = folds(idx, cfg, max_folds)
    spark = idx.sparkSession
    if k < 2:
        return spark.createDataFrame([(0, None, None)],
                                     "folds int, mean_accuracy double, std_accuracy double")
    data = model_table(with_class_weight(assemble(dealt, cfg)))
    rf = RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                                numTrees=100, maxDepth=8, seed=cfg.seed)
    ev = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    cv = CrossValidator(estimator=rf, estimatorParamMaps=ParamGridBuilder().build(),
                        evaluator=ev, foldCol="fold", numFolds=k, seed=cfg.seed)
    m = cv.fit(data)
    std = float(m.stdMetrics[0]) if m.stdMetrics else None
    return spark.createDataFrame([(k, float(m.avgMetrics[0]), std)],
                                 "folds int, mean_accuracy double, std_accuracy double")


def baseline_predictions(idx: DataFrame, cfg: Config | None = None) -> DataFrame:
    """What a model has to beat: for each test area the most frequent class of
    its region's training areas, or of all training areas where the region has
    none (ties: the first class by name).  Columns as of ``predictions``."""
    cfg = cfg or Config()
    s = model_table(split(prepare(idx, cfg), 0.2, cfg.seed))
    counts = s.where(~F.col("is_test")).groupBy("region_name", "priority", "label").agg(F.count(F.lit(1)).alias("_n"))
    top = F.min_by(F.struct("priority", "label"), F.struct((-F.col("_n")).alias("a"), F.col("priority").alias("b")))
    own = counts.groupBy("region_name").agg(top.alias("_own"))
    overall = counts.groupBy("priority", "label").agg(F.sum("_n").alias("_n")).select(top).scalar()
    test = s.where(F.col("is_test")).alias("t").join(own.alias("o"), F.col("t.region_name").eqNullSafe(F.col("o.region_name")), "left")
    guess = F.coalesce("_own", overall)
    return test.select(guess["label"].alias("prediction"), *[f"t.{c}" for c in KEYS], "t.priority", "t.label",
                       guess["priority"].alias("predicted_priority"))


def metrics(pred: DataFrame, classes=C.PRIORITY_ORDER) -> DataFrame:
    """Per class precision / recall / F1 / support (0 when undefined), in
    severity order, plus overall accuracy on every row."""
    spark = pred.sparkSession
    cls = spark.createDataFrame([(c, i) for i, c in enumerate(classes, 1)],
                                "cls string, cls_ord int")
    actual = pred.groupBy(F.col("priority").alias("cls")).agg(
        F.count(F.lit(1)).alias("support"))
    predicted = pred.groupBy(F.col("predicted_priority").alias("cls")).agg(
        F.count(F.lit(1)).alias("n_pred"))
    hit = pred.where(F.col("priority") == F.col("predicted_priority")) \
              .groupBy(F.col("priority").alias("cls")).agg(F.count(F.lit(1)).alias("tp"))
    acc = pred.select((F.sum(F.when(F.col("priority") == F.col("predicted_priority"), 1)
                             .otherwise(0)) / F.count(F.lit(1))).alias("a")).scalar()
    t = F.broadcast(cls).join(actual, "cls", "left").join(predicted, "cls", "left") \
         .join(hit, "cls", "left").fillna(0, subset=["support", "n_pred", "tp"])
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    return t.select(F.col("cls").alias("priority"), "cls_ord", prec.alias("precision"),
                    rec.alias("recall"), f1.alias("f1"),
                    F.col("support").cast("bigint").alias("support"),
                    F.coalesce(acc, F.lit(0.0)).alias("accuracy"))


def confusion(pred: DataFrame, classes=C.PRIORITY_ORDER) -> DataFrame:
    """Actual x predicted counts over the fixed class list (zero-filled)."""
    spark = pred.sparkSession
    cls = spark.createDataFrame([(c, i) for i, c in enumerate(classes, 1)],
                                "priority string, cls_ord int")
    wide = pred.groupBy("priority").pivot("predicted_priority", list(classes)) \
               .agg(F.count(F.lit(1)))
    out = F.broadcast(cls).join(wide, "priority", "left")
    names = [f"pred_{i}" for i in range(1, len(classes) + 1)]
    return out.select("priority", "cls_ord", *[
        F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("bigint").alias(n)
        for c, n in zip(classes, names)])


def standardize(idx: DataFrame, cfg: Config | None = None, digits: int | None = None
                ) -> DataFrame:
    """z-score of every model feature over all areas with population std
    (a constant column gets scale 1); mean/std from one scalar subquery."""
    cfg = cfg or Config()
    feats = list(cfg.model_features)
    base = idx.select(*KEYS, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                               for c in feats])
    st = base.select(F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s"))
                                .alias(c) for c in feats])).scalar()
    out = base.withColumn("_st", st)
    cols = []
    for c in feats:
        m, s = F.col("_st")[c]["m"], F.col("_st")[c]["s"]
        z = (F.col(c) - m) / F.when(s == 0, F.lit(1.0)).otherwise(s)
        cols.append((round_half_even(z, digits) if digits is not None else z).alias(f"{c}_z"))
    return out.select(*KEYS, *cols)


def _zscored_vectors(idx: DataFrame, cfg: Config) -> DataFrame:
    z = standardize(idx, cfg)
    zc = [f"{c}_z" for c in cfg.model_features]
    return VectorAssembler(inputCols=zc, outputCol="features").transform(z)


def _fit_kmeans(data: DataFrame, k: int, seed: int):
    return KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(data)


def _best_kmeans(data: DataFrame, k: int, n_init: int, seed: int, parallel: int = 8):
    """Best (lowest within-cluster cost) of ``n_init`` seeded runs; runs are
    submitted concurrently as independent Spark jobs."""
    with ThreadPoolExecutor(max_workers=max(1, min(parallel, n_init))) as ex:
        models = list(ex.map(lambda i: _fit_kmeans(data, k, seed + i), range(n_init)))
    return min(models, key=lambda m: m.summary.trainingCost)


def elbow(idx: DataFrame, cfg: Config | None = None, ks=range(2, 9), n_init: int = 10,
          parallel: int = 8) -> DataFrame:
    """Within-cluster sum of squares for each k (best of n_init starts); all
    (k, start) fits run as concurrent Spark jobs over the checkpointed z-scores."""
    cfg = cfg or Config()
    data = model_table(_zscored_vectors(idx, cfg))
    jobs = [(k, cfg.seed + i) for k in ks for i in range(n_init)]
    with ThreadPoolExecutor(max_workers=parallel) as ex:
        costs = list(ex.map(lambda j: (j[0], _fit_kmeans(data, *j).summary.trainingCost), jobs))
    best = {}
    for k, c in costs:
        best[k] = min(c, best.get(k, float("inf")))
    return idx.sparkSession.createDataFrame([(k, float(best[k])) for k in ks],
                                            "k int, inertia double")


def kmeans(idx: DataFrame, cfg: Config | None = None, n_init: int = 10, labels: tuple[str, ...] = ()) -> DataFrame:
    """Cluster every area (no case minimum) on z-scored features; the
    cluster id is relabelled by ascending mean rate (0 = lowest rate)."""
    cfg = cfg or Config()
    data = model_table(_zscored_vectors(idx, cfg))
    model = _best_kmeans(data, cfg.n_clusters, n_init, cfg.seed)
    assigned = model.transform(data).select(*KEYS, F.col("cluster").alias("raw_cluster"))
    feats = idx.select(*KEYS, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                                for c in cfg.model_features])
    j = assigned.join(feats, list(KEYS))
    order = cluster_order(j, labels)
    return j.join(F.broadcast(order), "raw_cluster").drop("raw_cluster")


def cluster_order(assigned: DataFrame, labels: tuple[str, ...] = ()) -> DataFrame:
    """raw cluster id -> rank of its mean rate (k rows) and label: the
    caller's, by rank, or the rank's number."""
    means = assigned.groupBy("raw_cluster").agg(F.avg("rate_100k").alias("_mr"))
    w = Window.orderBy("_mr", "raw_cluster")                         # k rows
    names = F.array(*[F.lit(x) for x in labels]) if labels else F.array().cast("array<string>")
    rank = (F.row_number().over(w) - 1).cast("int")
    return means.select("raw_cluster", rank.alias("cluster"),
                        F.coalesce(F.try_element_at(names, rank + 1),
                                   F.concat(F.lit("Cluster "), rank.cast("string")))
                        .alias("cluster_label"))


def cluster_rank(clustered: DataFrame) -> DataFrame:
    """Clusters by ascending mean rate: cluster, label, mean_rate and rank (k rows)."""
    means = clustered.groupBy("cluster", "cluster_label").agg(F.avg("rate_100k").alias("mean_rate"))
    return means.withColumn("rank", F.row_number().over(Window.orderBy("mean_rate", "cluster")))


def cluster_profile(clustered: DataFrame, cfg: Config | None = None) -> DataFrame:
    cfg = cfg or Config()
    return clustered.groupBy("cluster", "cluster_label").agg(
        F.count(F.lit(1)).cast("bigint").alias("areas"),
        *[round_half_even(F.avg(c), 4).alias(c) for c in cfg.model_features])
