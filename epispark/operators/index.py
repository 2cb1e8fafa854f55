"""Area-level composite priority index.

Plan shape (cases -> areas is the only case-level shuffle):

    clean cases --groupBy(area keys), partial aggregation--> area table
      --left join population--> --region mean (tiny aggregate) join--> impute
      --checkpoint (shared folder)--> min/max as one scalar subquery -> score
      --score histogram (<= 10,001 rows: score is rounded to 2 dp in [0, 100])
        cumulated and joined back--> national rank

No window ever runs over unbounded data: the only unpartitioned window is
over the score histogram, whose size is bounded by the rounding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import PRIORITY_ORDER, Config
from ..functions import derive as D
from ..functions.core import flag01, mean_2dp, round_half_even, share
from ..session import materialize
from .joins import impute_population, join_population

AREA_KEYS = ("area_code", "region_name", "local_name")
SHARE_COLUMNS = ("pct_adolescent", "pct_young_adult", "pct_hospitalised",
                 "pct_psychiatric", "pct_minor", "pct_female", "pct_rural")


COUNT_COLUMNS = ("cases", "rows", "adolescent", "young_adult", "hospitalised", "psychiatric", "minor", "female",
                 "rural", "cases_h1", "cases_h2")


def area_counts(cases: DataFrame, keys=AREA_KEYS) -> DataFrame:
    """Per area the counts that its shares are made of.  They are additive:
    the counts of two disjoint sets of cases add up to those of both."""
    f = cases.where(F.col(keys[0]).isNotNull())
    for k in keys[1:]:
        f = f.where(F.col(k).isNotNull())
    age, second = F.col("age"), F.col("epi_week") > 26
    flags = {"adolescent": age.between(12, 17), "young_adult": age.between(18, 25),
             "hospitalised": F.col("hospital_code") == 1,
             "psychiatric": F.col("gp_psychiatric") == 1 if "gp_psychiatric" in cases.columns else F.lit(False),
             "minor": F.col("is_minor"), "female": F.col("sex") == "F", "rural": F.col("is_rural"),
             "cases_h1": ~F.coalesce(second, F.lit(False)), "cases_h2": second}
    return f.groupBy(*keys).agg(
        F.count("case_id").cast("bigint").alias("cases"), F.count(F.lit(1)).cast("bigint").alias("rows"),
        *[F.sum(flag01(c)).cast("bigint").alias(name) for name, c in flags.items()])


def add_counts(counts: DataFrame, keys=AREA_KEYS) -> DataFrame:
    """Counts of several batches of cases, added up by area."""
    return counts.groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(c) for c in COUNT_COLUMNS])


def area_shares(counts: DataFrame, keys=AREA_KEYS) -> DataFrame:
    """The area table from its counts."""
    return with_trend(counts.select(*keys, "cases", "cases_h1", "cases_h2", *[
        share(F.col(c[len("pct_"):]), F.col("rows")).alias(c) for c in SHARE_COLUMNS]))


def area_table(cases: DataFrame, keys=AREA_KEYS) -> DataFrame:
    """Per area: cases (non-null ids), shares over all rows of the area
    (null inputs count as 'no'), first/second-half counts (null week -> H1)."""
    return area_shares(area_counts(cases, keys), keys)


def with_trend(areas: DataFrame) -> DataFrame:
    """(H2 - H1) / H1, 1.0 when H1 = 0, clamped to [-1, 1]."""
    h1, h2 = F.col("cases_h1").cast("double"), F.col("cases_h2").cast("double")
    raw = F.when(h1 == 0, F.lit(1.0)).otherwise((h2 - h1) / h1)
    return areas.withColumn("trend", F.greatest(F.least(raw, F.lit(1.0)), F.lit(-1.0)))


def with_rate(areas: DataFrame) -> DataFrame:
    """Cases per 100,000 inhabitants; null when the population is 0 (ANSI
    mode would otherwise fail the job on the division)."""
    pop = F.col("population")
    return areas.withColumn(
        "rate_100k", F.when(pop != 0, F.col("cases").cast("double") / pop * F.lit(100000.0)))


def area_base(cases: DataFrame, population: DataFrame, cfg: Config | None = None,
              checkpoint: bool = True) -> DataFrame:
    """Area table + population (joined, imputed) + rate; checkpointed so the
    case-level aggregation runs once for every later step."""
    cfg = cfg or Config()
    return populated(area_table(cases), population, cfg, checkpoint)


def populated(areas: DataFrame, population: DataFrame, cfg: Config | None = None,
              checkpoint: bool = True) -> DataFrame:
    """Area table with population (joined, imputed) and rate."""
    areas = with_rate(impute_population(join_population(areas, population), cfg or Config()))
    return materialize(areas) if checkpoint else areas


def min_max(df: DataFrame, cols) -> DataFrame:
    """(x - min) / (max - min) per column as ``<col>_norm``; 0 for every row
    when the column is constant.  Min/max come from one scalar subquery (a
    single-row aggregate), not from a window or a cross join."""
    stats = df.select(F.struct(*[
        F.struct(F.min(c).alias("mn"), F.max(c).alias("mx")).alias(c) for c in cols
    ]).alias("s")).scalar()
    out = df.withColumn("_mm", stats)
    for c in cols:
        mn, mx = F.col("_mm")[c]["mn"], F.col("_mm")[c]["mx"]
        out = out.withColumn(f"{c}_norm",
                             F.when(mx == mn, F.lit(0.0))
                              .otherwise((F.col(c) - mn) / (mx - mn)))
    return out.drop("_mm")


def with_score(df: DataFrame, cfg: Config | None = None) -> DataFrame:
    """100 * sum(w_i * norm_i) in weight order, rounded half-even to 2 dp."""
    cfg = cfg or Config()
    total = None
    for name, w in cfg.weights:
        term = F.lit(w) * F.col(f"{name}_norm")
        total = term if total is None else total + term
    return df.withColumn("score", round_half_even(total * F.lit(100.0), 2))


def with_rank(df: DataFrame, score_col: str = "score", rank_col: str = "rank") -> DataFrame:
    """Rank by descending score, ties share the smallest rank ('min').

    rank = 1 + number of rows with a strictly higher score.  Counting goes
    through the histogram of distinct scores (the index has 2 digits in
    [0, 100], so at most 10,001 of them), cumulated and joined back."""
    hist = df.groupBy(score_col).agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy(F.col(score_col).desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranks = hist.select(score_col, (F.coalesce(F.sum("_cnt").over(w), F.lit(0)) + 1)
                        .cast("int").alias(rank_col))
    return df.join(ranks, score_col, "left")


def priority_index(areas: DataFrame, cfg: Config | None = None) -> DataFrame:
    """Normalise components, score, classify and rank the area table."""
    cfg = cfg or Config()
    comps = [name for name, _ in cfg.weights]
    scored = with_score(min_max(areas, comps), cfg)
    scored = scored.withColumn("priority", D.classify("score"))
    return with_rank(scored)


def index_flow(cases: DataFrame, population: DataFrame,
               cfg: Config | None = None, checkpoint: bool = True) -> DataFrame:
    """clean cases -> area table -> population -> index, class and rank."""
    return priority_index(area_base(cases, population, cfg, checkpoint), cfg)


def priority_distribution(idx: DataFrame) -> DataFrame:
    """Areas per class in severity order, zero classes included, with %."""
    spark = idx.sparkSession
    classes = spark.createDataFrame(
        [(n, i) for i, n in enumerate(PRIORITY_ORDER, 1)], "priority string, priority_ord int")
    counts = idx.groupBy("priority").agg(F.count(F.lit(1)).alias("areas"))
    total = idx.select(F.count(F.lit(1)).alias("t")).scalar()
    out = F.broadcast(classes).join(counts, "priority", "left") \
        .select("priority", "priority_ord",
                F.coalesce("areas", F.lit(0)).cast("bigint").alias("areas"))
    return out.withColumn("pct", round_half_even(
        F.when(total > 0, F.col("areas") / total * 100), 1))


def region_mean_index(idx: DataFrame) -> DataFrame:
    return idx.groupBy("region_name").agg(
        round_half_even(mean_2dp("score"), 2).alias("mean_score"))


def region_table(idx: DataFrame, top: int = 5) -> DataFrame:
    """Per region: mean and max index (2 dp), total cases, distinct area
    names, and whether the region is among the ``top`` by max index (ties:
    region name).  The top list has ``top`` rows, so it is broadcast."""
    reg = idx.groupBy("region_name").agg(
        round_half_even(mean_2dp("score"), 2).alias("mean_score"),
        round_half_even(F.max("score"), 2).alias("max_score"),
        F.sum("cases").cast("bigint").alias("cases"),
        F.count_distinct("local_name").cast("bigint").alias("areas"))
    best = reg.orderBy(F.col("max_score").desc(), "region_name").limit(top) \
              .select("region_name", F.lit(True).alias("is_top"))
    return reg.join(F.broadcast(best), "region_name", "left") \
              .withColumn("is_top", F.coalesce("is_top", F.lit(False))) \
              .withColumn("max_priority", D.classify("max_score"))


def map_points(regions: DataFrame, centroids: DataFrame) -> DataFrame:
    """Region bubbles: lon/lat, size = max(mean index, 10) * 0.9 + 8, and a
    border flag for the top regions."""
    from .joins import join_centroids
    j = join_centroids(regions, centroids)
    return j.select("region_name", "lon", "lat", "mean_score", "max_score", "cases",
                    (F.greatest(F.col("mean_score"), F.lit(10.0)) * 0.9 + 8)
                    .alias("bubble_size"),
                    F.col("is_top").alias("border"))


def priority_counts(idx: DataFrame) -> DataFrame:
    """# Crítica, # Alta, the first-ranked area (ties -> smallest code), the
    highest index, and the region with the highest mean index (ties ->
    smallest name; the mean comes from a per-region aggregate)."""
    reg = idx.groupBy("region_name").agg(mean_2dp("score").alias("_m"))
    top_reg = reg.select(F.min_by("region_name", F.struct((-F.col("_m")).alias("a"),
                                                          F.col("region_name").alias("b"))))
    return idx.agg(
        F.sum(flag01(F.col("priority") == "Crítica")).cast("bigint").alias("n_critical"),
        F.sum(flag01(F.col("priority") == "Alta")).cast("bigint").alias("n_high"),
        F.min_by("local_name", F.struct("rank", "area_code")).alias("top_local"),
        F.min_by("region_name", F.struct("rank", "area_code")).alias("top_region"),
        F.max("score").alias("max_score")).select("*", top_reg.scalar().alias(
            "top_region_by_mean"))


def scatter(idx: DataFrame, min_cases: int = 5) -> DataFrame:
    """Areas with at least ``min_cases``: rate vs adolescent share, class, size."""
    return idx.where(F.col("cases") >= min_cases).select(
        "area_code", "region_name", "local_name", "rate_100k", "pct_adolescent",
        "priority", "cases", "score")


def emerging(idx: DataFrame, cfg: Config | None = None, top: int = 10) -> DataFrame:
    """Fast-growing areas not yet critical: trend > threshold, class not
    Crítica, >= min cases; top n by trend (ties: index desc, code)."""
    cfg = cfg or Config()
    f = idx.where((F.col("trend") > cfg.emerging_trend) & (F.col("priority") != "Crítica")
                  & (F.col("cases") >= cfg.min_cases))
    return f.orderBy(F.col("trend").desc(), F.col("score").desc(), "area_code",
                     "region_name", "local_name").limit(top)


def top_ranking(idx: DataFrame, n: int = 20) -> DataFrame:
    """Top-n areas by rank, 7 columns, rounded for display."""
    return idx.orderBy("rank", "area_code", "region_name", "local_name").limit(n).select(
        "rank", "region_name", "local_name", "cases",
        round_half_even("rate_100k", 1).alias("rate_100k"),
        round_half_even("score", 2).alias("score"), "priority")
