"""Case cube: one aggregation of the clean table by its small dimensions,
from which the dashboard views are answered without touching case rows.

At 100 TB every descriptive table would otherwise scan a few columns of the
whole clean table; the cube is built by ONE partial aggregation and holds at
most areas x weeks x sexes x ages x area types x flags rows (usually far
fewer, it is sparse).  Counts add up, means come from exact integer sums,
and medians from the cells as weighted rows (``quantiles``) — the same values
as over the case rows.  Null dimension values are kept as their own cells so shares
keep nulls in their denominators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import derive as D
from ..functions.core import round_half_even, share
from .describe import PUBLIC_DIMS
from .quantiles import quantiles_by

CUBE_DIMS = ("area_code", "region_name", "local_name", "month", "epi_week", "sex",
             "age", "area_type", "hospital_code")
MEASURES = ("n", "n_ids")


def case_cube(clean: DataFrame, dims=CUBE_DIMS) -> DataFrame:
    """Cell counts (rows and non-null ids) by the given dimensions."""
    dims = [d for d in dims if d in clean.columns]
    return clean.groupBy(*dims).agg(F.count(F.lit(1)).alias("n"),
                                    F.count("case_id").alias("n_ids"))


def add_cells(cells: DataFrame) -> DataFrame:
    """The cube of all cases whose parts' cells are in ``cells``."""
    dims = [c for c in cells.columns if c not in MEASURES]
    return cells.groupBy(*dims).agg(*[F.sum(c).cast("bigint").alias(c) for c in MEASURES])


def _pct1(num, den):
    return round_half_even(share(num, den) * 100, 1)


def _sum_if(cond):
    return F.sum(F.when(cond, F.col("n")).otherwise(F.lit(0)))


def _mode(cube: DataFrame, col) -> F.Column:
    c = cube.where(col.isNotNull()).groupBy(col.alias("_v")).agg(F.sum("n").alias("_n"))
    return c.select(F.min_by("_v", F.struct((-F.col("_n")).alias("a"),
                                            F.col("_v").alias("b")))).scalar()


def kpis(cube: DataFrame) -> DataFrame:
    """The 14-KPI row of ``describe.kpis``, answered from the cube."""
    age, n = F.col("age"), F.col("n")
    total = F.sum(n)
    main = cube.agg(
        total.cast("bigint").alias("total_cases"),
        round_half_even(F.sum(age.cast("bigint") * n)
                        / F.sum(F.when(age.isNotNull(), n)), 1).alias("mean_age"),
        _pct1(_sum_if(F.col("sex") == "F"), total).alias("pct_female"),
        _pct1(_sum_if(F.col("sex") == "M"), total).alias("pct_male"),
        _pct1(_sum_if(D.is_minor(age)), total).alias("pct_minor"),
        _pct1(_sum_if(D.is_adolescent(age)), total).alias("pct_adolescent"),
        _pct1(_sum_if(F.col("hospital_code") == 1), total).alias("pct_hospitalised"),
        _pct1(_sum_if(D.is_rural(F.col("area_type"))), total).alias("pct_rural"))
    regions = cube.select(F.count_distinct("region_name")).scalar()
    areas = cube.select(F.count_distinct("area_code")).scalar()
    median = quantiles_by(cube, "age", (0.5,), weight="n").select(F.col("q")[0]).scalar()
    return main.select(
        "total_cases", "mean_age", median.alias("median_age"), *main.columns[2:],
        regions.cast("bigint").alias("regions"), areas.cast("bigint").alias("areas"),
        _mode(cube, F.col("region_name")).alias("top_region"),
        _mode(cube, F.col("month")).alias("top_month"),
        _mode(cube, D.age_group(age)).alias("top_age_group"))


def by_label(cube: DataFrame, label, name: str) -> DataFrame:
    """Cases and % per label of a small fixed domain (null label excluded)."""
    t = cube.where(label.isNotNull()).groupBy(label.alias(name)) \
            .agg(F.sum("n").cast("bigint").alias("cases"))
    return t.withColumn("pct", _pct1(F.col("cases"), t.select(F.sum("cases")).scalar()))


def by_sex(cube: DataFrame) -> DataFrame:
    return by_label(cube, D.sex_label("sex"), "sex_label")


def by_age_group(cube: DataFrame) -> DataFrame:
    age = F.col("age")
    t = cube.where(D.age_group(age).isNotNull()).groupBy(
        D.age_group(age).alias("age_group"), D.age_group_ord(age).alias("age_group_ord")) \
        .agg(F.sum("n").cast("bigint").alias("cases"))
    return t.withColumn("pct", _pct1(F.col("cases"), t.select(F.sum("cases")).scalar()))


def weekly_trend(cube: DataFrame, window: int = 4, k: int = 0) -> DataFrame:
    """Cases per week and their moving mean.  With ``k`` weeks of fewer cases
    are left out, and so is every mean that one of them is part of: with its
    neighbours it would give the hidden count away."""
    t = cube.where(F.col("epi_week").isNotNull()).groupBy("epi_week") \
            .agg(F.sum("n").cast("bigint").alias("cases"))
    w = Window.orderBy("epi_week").rowsBetween(-(window - 1), 0)     # <= 53 rows
    mean = round_half_even(F.avg("cases").over(w), 1)
    if not k:
        return t.withColumn("moving_avg", mean)
    return t.withColumn("moving_avg", F.when(F.min("cases").over(w) >= k, mean)).where(F.col("cases") >= k)


def by_region(cube: DataFrame) -> DataFrame:
    total = F.sum("n")
    return cube.where(F.col("region_name").isNotNull()).groupBy("region_name").agg(
        F.sum("n_ids").cast("bigint").alias("cases"),
        _pct1(_sum_if(D.is_minor(F.col("age"))), total).alias("pct_minor"),
        _pct1(_sum_if(F.col("hospital_code") == 1), total).alias("pct_hospitalised"))



def filter_cube(cube: DataFrame, region: str | None = None, sex: str | None = None,
                months=None, area: str | None = None) -> DataFrame:
    """The interactive filter of ``describe.filter_cases`` applied to cells."""
    pred = F.lit(True)
    if region is not None:
        pred = pred & (F.col("region_name") == region)
    if sex is not None:
        pred = pred & (D.sex_label("sex") == sex)
    if months:
        pred = pred & F.col("month").isin(*months)
    if area is not None:
        pred = pred & (D.area_label("area_type") == area)
    return cube.where(pred)


def kpis_filtered(cube: DataFrame) -> DataFrame:
    """The 6 KPIs of ``describe.kpis_filtered`` from (filtered) cells."""
    total = F.sum("n")
    main = cube.agg(
        F.coalesce(total, F.lit(0)).cast("bigint").alias("total_cases"),
        F.coalesce(_pct1(_sum_if(D.is_adolescent(F.col("age"))), total), F.lit(0.0))
         .alias("pct_adolescent"),
        F.coalesce(_pct1(_sum_if(F.col("hospital_code") == 1), total), F.lit(0.0))
         .alias("pct_hospitalised"))
    return main.select(
        "*",
        cube.select(F.count_distinct("region_name")).scalar().cast("bigint").alias("regions"),
        cube.select(F.count_distinct("area_code")).scalar().cast("bigint").alias("areas"),
        F.coalesce(_mode(cube, F.col("region_name")), F.lit("–")).alias("top_region"))


def by_month(cube: DataFrame) -> DataFrame:
    t = cube.where(F.col("month").isNotNull()).groupBy("month") \
            .agg(F.sum("n").cast("bigint").alias("cases"))
    return t.withColumn("month_name", D.month_name("month", short=True))


def by_area_type(cube: DataFrame) -> DataFrame:
    return by_label(cube, D.area_label("area_type"), "area_label")


def by_quarter(cube: DataFrame) -> DataFrame:
    q = D.quarter(F.col("epi_week"))
    return cube.where(q.isNotNull()).groupBy(q.alias("quarter")) \
               .agg(F.sum("n").cast("bigint").alias("cases"))


def semester_change(cube: DataFrame) -> DataFrame:
    s = D.semester(F.col("epi_week"))
    t = cube.agg(_sum_if(s == "H1 (Sem 1–26)").cast("bigint").alias("cases_h1"),
                 _sum_if(s == "H2 (Sem 27–52)").cast("bigint").alias("cases_h2"))
    return t.withColumn("pct_change", round_half_even(
        share(F.col("cases_h2") - F.col("cases_h1"), F.col("cases_h1")) * 100, 1))


def age_by_sex(cube: DataFrame) -> DataFrame:
    """Age group x sex label with totals (``cube`` + ``grouping_id``)."""
    cells = cube.select(D.age_group(F.col("age")).alias("age_group"),
                        D.sex_label("sex").alias("sex_label"), "n") \
                .where(F.col("age_group").isNotNull())
    t = cells.cube("age_group", "sex_label").agg(
        F.sum("n").cast("bigint").alias("cases"), F.grouping_id().cast("int").alias("grouping_id"))
    return t.select(
        F.when(F.col("grouping_id").bitwiseAND(2) == 2, F.lit("Total"))
         .otherwise(F.col("age_group")).alias("age_group"),
        F.when(F.col("grouping_id").bitwiseAND(1) == 1, F.lit("Total"))
         .otherwise(F.col("sex_label")).alias("sex_label"),
        "cases", "grouping_id")


def public_top_areas(cube: DataFrame, k: int = 5, top: int = 20) -> DataFrame:
    """Areas by cases (non-null ids), cells under k suppressed, then top n."""
    keys = ("area_code", "region_name", "local_name")
    f = cube
    for c in keys:
        f = f.where(F.col(c).isNotNull())
    t = f.groupBy(*keys).agg(F.sum("n_ids").cast("bigint").alias("cases"))
    return t.where(F.col("cases") >= k).orderBy(F.col("cases").desc(), *keys).limit(top)


def cumulative_age(cube: DataFrame) -> DataFrame:
    """Age-group shares with the running share over ordered groups."""
    t = by_age_group(cube)
    w = Window.orderBy("age_group_ord").rowsBetween(Window.unboundedPreceding, 0)  # <= 7 rows
    total = t.select(F.sum("cases")).scalar()
    return t.withColumn("cum_cases", F.sum("cases").over(w).cast("bigint")) \
            .withColumn("cum_pct", _pct1(F.col("cum_cases"), total))


def month_by_sex(cube: DataFrame) -> DataFrame:
    """Month x sex label counts, zero-filled (wide), as ``crosstab.month_by_sex``."""
    from .crosstab import SEX_COLUMNS, SEX_VALUES
    lab = D.sex_label("sex")
    f = cube.where(F.col("month").isNotNull())
    return f.groupBy("month").agg(
        *[_sum_if(lab == v).cast("bigint").alias(n) for v, n in zip(SEX_VALUES, SEX_COLUMNS)]
    ).withColumn("month_name", D.month_name("month", short=True))


def public_cells(cube: DataFrame, dims=PUBLIC_DIMS) -> DataFrame:
    """The published cells of ``describe.public_cells``, small ones included."""
    cells = cube.withColumns({"sex_label": D.sex_label("sex"), "age_group": D.age_group(F.col("age")),
                              "area_label": D.area_label("area_type")})
    for d in dims:
        cells = cells.where(F.col(d).isNotNull())
    return cells.groupBy(*dims).agg(F.sum("n").cast("bigint").alias("cases"))
