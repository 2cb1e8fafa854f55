"""Descriptive tables over the clean case table.

Each table is one ``groupBy``/``agg`` (partial aggregation before the
shuffle, so a region holding a third of all cases costs no more than any
other); shares are exact count ratios; modes break ties on the smallest key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions import derive as D
from ..functions.core import count_if, flag01, round_half_even, share
from .quantiles import quantiles_by


def pct1(num: Column, den: Column) -> Column:
    """Percentage rounded half-even to 1 dp."""
    return round_half_even(share(num, den) * 100, 1)


def _mode(df: DataFrame, col: str) -> Column:
    """Scalar subquery: most frequent non-null value, ties -> smallest."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    return counts.select(F.min_by(col, F.struct((-F.col("_n")).alias("a"),
                                                F.col(col).alias("b")))).scalar()


def filter_cases(df: DataFrame, region: str | None = None, sex: str | None = None,
                 months=None, area: str | None = None) -> DataFrame:
    """AND of optional predicates (region, sex label, months, area label);
    an empty month list means no month filter.  Pushed down by Catalyst."""
    pred = F.lit(True)
    if region is not None:
        pred = pred & (F.col("region_name") == region)
    if sex is not None:
        pred = pred & (F.col("sex_label") == sex)
    if months:
        pred = pred & F.col("month").isin(*months)
    if area is not None:
        pred = pred & (F.col("area_label") == area)
    return df.where(pred)


def region_list(df: DataFrame) -> DataFrame:
    return df.where(F.col("region_name").isNotNull()).select("region_name").distinct()


def _mode_of_domain(counts: Column, labels) -> Column:
    """Most frequent value of a fixed domain from its per-value counts
    (first maximum = smallest value on ties); null when all counts are 0."""
    top = F.array_max(counts)
    pos = F.array_position(counts, top).cast("int")
    return F.when(top > 0, F.element_at(F.array(*[F.lit(v) for v in labels]), pos))


def kpis(df: DataFrame) -> DataFrame:
    """14 headline KPIs in one row.  One aggregation computes the shares,
    mean and the per-value counts of the fixed domains (12 months,
    7 age groups) whose modes follow; distinct counts and the region mode
    (open domain) are small separate aggregates joined as scalar subqueries."""
    n = F.count(F.lit(1))
    month_counts = F.array(*[count_if(F.col("month") == m) for m in range(1, 13)])
    age_counts = F.array(*[count_if(F.col("age_group") == g) for g in C.AGE_LABELS])
    main = df.agg(
        n.cast("bigint").alias("total_cases"),
        round_half_even(F.avg("age"), 1).alias("mean_age"),
        pct1(F.sum(flag01(F.col("sex") == "F")), n).alias("pct_female"),
        pct1(F.sum(flag01(F.col("sex") == "M")), n).alias("pct_male"),
        pct1(F.sum(flag01(F.col("is_minor"))), n).alias("pct_minor"),
        pct1(F.sum(flag01(F.col("is_adolescent"))), n).alias("pct_adolescent"),
        pct1(F.sum(flag01(F.col("hospital_code") == 1)), n).alias("pct_hospitalised"),
        pct1(F.sum(flag01(F.col("is_rural"))), n).alias("pct_rural"),
        month_counts.alias("_mc"), age_counts.alias("_ac"),
    )
    # one pre-aggregate by region and area serves all open-domain figures
    pairs = df.groupBy("region_name", "area_code").agg(F.count(F.lit(1)).alias("_n"))
    top = (pairs.where(F.col("region_name").isNotNull()).groupBy("region_name").agg(F.sum("_n").alias("_n"))
           .select(F.min_by("region_name", F.struct((-F.col("_n")).alias("a"), F.col("region_name").alias("b")))))
    median = quantiles_by(df, "age", (0.5,)).select(F.col("q")[0]).scalar()
    return main.select(
        "total_cases", "mean_age", median.alias("median_age"),
        *[c for c in main.columns[2:] if not c.startswith("_")],
        pairs.select(F.count_distinct("region_name")).scalar().cast("bigint").alias("regions"),
        pairs.select(F.count_distinct("area_code")).scalar().cast("bigint").alias("areas"),
        top.scalar().alias("top_region"),
        _mode_of_domain(F.col("_mc"), list(range(1, 13))).alias("top_month"),
        _mode_of_domain(F.col("_ac"), C.AGE_LABELS).alias("top_age_group"))


def kpis_filtered(df: DataFrame) -> DataFrame:
    """6 KPIs over a filtered selection; 0 / '–' when it is empty."""
    n = F.count(F.lit(1))
    main = df.agg(
        n.cast("bigint").alias("total_cases"),
        F.coalesce(pct1(F.sum(flag01(F.col("is_adolescent"))), n), F.lit(0.0))
         .alias("pct_adolescent"),
        F.coalesce(pct1(F.sum(flag01(F.col("hospital_code") == 1)), n), F.lit(0.0))
         .alias("pct_hospitalised"))
    return main.select(
        "*",
        df.select(F.count_distinct("region_name")).scalar().cast("bigint").alias("regions"),
        df.select(F.count_distinct("area_code")).scalar().cast("bigint").alias("areas"),
        F.coalesce(_mode(df, "region_name"), F.lit("–")).alias("top_region"))


def by_region(df: DataFrame, top: int | None = None) -> DataFrame:
    """Cases (non-null ids), % minors and % hospitalised per region."""
    n = F.count(F.lit(1))
    t = df.where(F.col("region_name").isNotNull()).groupBy("region_name").agg(
        F.count("case_id").cast("bigint").alias("cases"),
        pct1(F.sum(flag01(F.col("is_minor"))), n).alias("pct_minor"),
        pct1(F.sum(flag01(F.col("hospital_code") == 1)), n).alias("pct_hospitalised"))
    if top:
        t = t.orderBy(F.col("cases").desc(), "region_name").limit(top)
    return t


def by_area(df: DataFrame, top: int | None = 20) -> DataFrame:
    """Cases per area (code, region, name); the top n by cases (ties: keys),
    or every area when ``top`` is None."""
    keys = ("area_code", "region_name", "local_name")
    f = df
    for k in keys:
        f = f.where(F.col(k).isNotNull())
    t = f.groupBy(*keys).agg(F.count("case_id").cast("bigint").alias("cases"))
    return t if top is None else t.orderBy(F.col("cases").desc(), *keys).limit(top)


def _with_share(t: DataFrame, n_col: str = "cases") -> DataFrame:
    """Share of each group in the grand total (a scalar subquery over the
    grouped counts, whose shuffle is reused)."""
    total = t.select(F.sum(n_col)).scalar()
    return t.withColumn("pct", pct1(F.col(n_col), total))


def by_label(df: DataFrame, col: str) -> DataFrame:
    """Cases and % for a label column with a small fixed domain (sex, area
    type, ...); the null group is excluded."""
    t = df.where(F.col(col).isNotNull()).groupBy(col) \
          .agg(F.count(F.lit(1)).cast("bigint").alias("cases"))
    return _with_share(t)


def by_sex(df: DataFrame) -> DataFrame:
    return by_label(df, "sex_label")


def by_area_type(df: DataFrame) -> DataFrame:
    return by_label(df, "area_label")


def by_age_group(df: DataFrame) -> DataFrame:
    """Cases and % of grouped cases per age group, with bin ordinal."""
    t = df.where(F.col("age_group").isNotNull()).groupBy("age_group", "age_group_ord") \
          .agg(F.count(F.lit(1)).cast("bigint").alias("cases"))
    return _with_share(t)


def by_month(df: DataFrame) -> DataFrame:
    t = df.where(F.col("month").isNotNull()).groupBy("month") \
          .agg(F.count(F.lit(1)).cast("bigint").alias("cases"))
    return t.withColumn("month_name", D.month_name("month", short=True))


def by_quarter(df: DataFrame) -> DataFrame:
    return df.where(F.col("quarter").isNotNull()).groupBy("quarter") \
             .agg(F.count(F.lit(1)).cast("bigint").alias("cases"))


def semester_change(df: DataFrame) -> DataFrame:
    """First-half and second-half totals and the % change."""
    h1 = count_if(F.col("semester") == C.SEMESTER_LABELS[0])
    h2 = count_if(F.col("semester") == C.SEMESTER_LABELS[1])
    t = df.agg(h1.alias("cases_h1"), h2.alias("cases_h2"))
    return t.withColumn("pct_change", round_half_even(
        share(F.col("cases_h2") - F.col("cases_h1"), F.col("cases_h1")) * 100, 1))


def cumulative_age(df: DataFrame) -> DataFrame:
    """Age-group shares with the running share over ordered groups (the
    share under 26 is the running value at the 18–25 group)."""
    t = by_age_group(df)
    w = Window.orderBy("age_group_ord").rowsBetween(Window.unboundedPreceding, 0)  # <= 7 rows
    total = t.select(F.sum("cases")).scalar()
    return t.withColumn("cum_cases", F.sum("cases").over(w).cast("bigint")) \
            .withColumn("cum_pct", pct1(F.col("cum_cases"), total))


def risk_groups(df: DataFrame, min_cases: int = 0, exclude=()) -> DataFrame:
    """Per risk flag column (``gp_*``): rows with code 1 and % of all rows
    (2 dp) — one pass over all flag columns, then unpivot."""
    cols = [c for c in df.columns if c.startswith("gp_") and c not in exclude]
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "group string, label string, cases bigint, pct double")
    wide = df.agg(F.count(F.lit(1)).alias("_t"),
                  *[count_if(F.col(c) == 1).alias(c) for c in cols])
    long = wide.unpivot(["_t"], cols, "group", "cases")
    return long.where(F.col("cases") >= min_cases).select(
        "group", D.gp_label("group").alias("label"), F.col("cases").cast("bigint"),
        round_half_even(share(F.col("cases"), F.col("_t")) * 100, 2).alias("pct")) \
        .orderBy(F.col("cases").desc(), "group")


def top_age_group(df: DataFrame) -> DataFrame:
    """Largest age group (ties -> earlier group)."""
    t = by_age_group(df)
    return t.agg(F.max_by("age_group", F.struct("cases", -F.col("age_group_ord")))
                 .alias("age_group"), F.max("cases").alias("cases"))


def exec_summary(cases: DataFrame, idx: DataFrame) -> DataFrame:
    """Final metrics over cases and areas (one row)."""
    n = F.count(F.lit(1))
    c = cases.agg(
        n.cast("bigint").alias("total_cases"),
        pct1(F.sum(flag01(F.col("is_adolescent"))), n).alias("pct_adolescent"),
        pct1(F.sum(flag01(F.col("hospital_code") == 1)), n).alias("pct_hospitalised"))
    a = idx.agg(
        count_if(F.col("priority").isin("Alta", "Crítica")).alias("areas_high_or_critical"),
        F.min_by("local_name", F.struct("rank", "area_code")).alias("top_local"),
        F.max("score").alias("max_score")).select(
        F.struct("areas_high_or_critical", "top_local", "max_score")).scalar()
    return c.select(
        "*",
        cases.select(F.count_distinct("region_name")).scalar().cast("bigint").alias("regions"),
        cases.select(F.count_distinct("area_code")).scalar().cast("bigint").alias("areas"),
        a["areas_high_or_critical"].alias("areas_high_or_critical"),
        a["top_local"].alias("top_local"), a["max_score"].alias("max_score"))


PUBLIC_DIMS = ("area_code", "region_name", "local_name", "month", "sex_label", "age_group",
               "area_label")


def public_cells(df: DataFrame, dims=PUBLIC_DIMS) -> DataFrame:
    """Case counts by the 7 published dimensions (rows with a null key are
    left out, as a group-by on them would)."""
    f = df
    for d in dims:
        f = f.where(F.col(d).isNotNull())
    return f.groupBy(*dims).agg(F.count(F.lit(1)).cast("bigint").alias("cases"))
