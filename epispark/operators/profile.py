"""Raw-data profiling: shape, head, types, describe, duplicates, nulls,
value counts, column roles.  Each profile is one aggregation pass (wide
``agg`` then ``unpivot``), never one pass per column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.core import round_half_even, row_digest
from .quantiles import quantiles_by


def shape(df: DataFrame, id_col: str = "case_id") -> DataFrame:
    """Row and column counts plus event name and year of the first case
    (first = smallest id, deterministic under any partitioning)."""
    first = F.struct(F.col(id_col).isNull(), F.col(id_col))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min_by("event_name", first).alias("event_name"),
        F.min_by("epi_year", first).alias("epi_year"),
    ).withColumn("n_columns", F.lit(len(df.columns)))


def head(df: DataFrame, n: int = 3, id_col: str = "case_id") -> DataFrame:
    """First n rows (by id), transposed to (row_no, column, value)."""
    order = F.col(id_col).asc_nulls_last()
    top = df.orderBy(order).limit(n)          # TakeOrdered: per-partition top-n
    top = top.withColumn("row_no", F.row_number().over(Window.orderBy(order)))  # n rows
    cols = list(df.columns)
    str_cols = [F.col(c).cast("string").alias(c) for c in cols]
    wide = top.select("row_no", *str_cols)
    return wide.unpivot(["row_no"], cols, "column", "value")


def dtypes(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    spark = spark or df.sparkSession
    return spark.createDataFrame(df.dtypes, "column string, type string")


def describe(df: DataFrame, cols=("age", "epi_week")) -> DataFrame:
    """count, mean, sample std, min, quartiles (linear interpolation), max,
    rounded to 2 dp — one row per variable: the moments from one aggregation,
    the quartiles of all variables selected together."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = []
    for c in cols:
        rows.append(F.struct(
            F.lit(c).alias("variable"), F.col(f"{c}__count").cast("bigint").alias("count"),
            round_half_even(F.col(f"{c}__mean"), 2).alias("mean"),
            round_half_even(F.col(f"{c}__std"), 2).alias("std"),
            round_half_even(F.col(f"{c}__min"), 2).alias("min"),
            round_half_even(F.col(f"{c}__max"), 2).alias("max")))
    moments = wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "variable", "x")
    quart = quantiles_by(long, "x", (0.25, 0.5, 0.75), ["variable"])
    return moments.join(quart, "variable", "left").select(
        "variable", "count", "mean", "std", "min", *[round_half_even(F.col("q")[i], 2).alias(n) for i, n in enumerate(("p25", "p50", "p75"))],
        "max")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier identical row (count - distinct rows), told
    apart by a 128-bit digest: 16 bytes a distinct row are shuffled, and a
    heavily repeated row collapses before."""
    distinct = df.select(*row_digest(df.columns)).groupBy("_digest1", "_digest2").agg(F.count(F.lit(1)).alias("_n"))
    return distinct.agg((F.sum("_n") - F.count(F.lit(1))).cast("bigint").alias("duplicate_rows"))


def duplicate_ids(df: DataFrame, id_col: str = "case_id") -> DataFrame:
    """Repeated ids (null ids compare equal, as one group)."""
    per = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint")
                   .alias("duplicate_ids"))


def null_pct(df: DataFrame) -> DataFrame:
    """% null per column (1 dp), only columns above 0, most null first."""
    total = F.count(F.lit(1))
    wide = df.agg(total.alias("_t"), *[
        (F.count(F.lit(1)) - F.count(F.col(c))).alias(c) for c in df.columns])
    long = wide.unpivot(["_t"], df.columns, "column", "n_null")
    return long.select(
        "column", F.col("n_null").cast("bigint").alias("n_null"),
        round_half_even(F.col("n_null") / F.col("_t") * 100, 1).alias("pct_null"),
    ).where(F.col("pct_null") > 0).orderBy(F.col("pct_null").desc(), "column")


def value_counts(df: DataFrame, cols=("sex", "area_type", "hospital_code")) -> DataFrame:
    """Frequencies per column, null kept as its own value."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]) \
             .unpivot([], list(cols), "column", "value")
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def top_values(df: DataFrame, col: str = "region_name", n: int = 5) -> DataFrame:
    """Top-n non-null values by frequency (ties: smaller value first)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.col("n").desc(), F.col(col)).limit(n))


def empty_columns(df: DataFrame) -> DataFrame:
    """Columns whose every value is null."""
    wide = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column", "n_values") \
               .where(F.col("n_values") == 0).select("column")


ROLE_COLUMNS = {
    "id": ("case_id", "event_code"),
    "temporal": ("notified_text", "onset_text", "consulted_text", "admitted_text",
                 "born_text", "epi_week", "epi_year", "notified_on", "onset_on",
                 "consulted_on", "admitted_on", "born_on"),
    "demographic": ("age", "age_unit", "sex", "ethnicity", "occupation", "stratum",
                    "nationality"),
    "geographic": ("region_code", "local_code", "area_type", "region_name", "local_name",
                   "residence_region_code", "residence_local_code"),
    "clinical": ("hospital_code",),
}


def column_roles(df: DataFrame) -> dict[str, list[str]]:
    """Classify present columns by role (schema-only, no data pass)."""
    out = {role: [c for c in df.columns if c in names] for role, names in ROLE_COLUMNS.items()}
    out["risk"] = [c for c in df.columns if c.startswith("gp_")]
    return out


def column_role_table(df: DataFrame, high_null: float = 50.0) -> DataFrame:
    """(role, column, pct_null): the roles as rows; ``high_null`` has the
    columns of which a larger share (in %) is null."""
    spark = df.sparkSession
    pairs = [(role, c) for role, names in column_roles(df).items() for c in names]
    n = F.count(F.lit(1))
    nulls = df.agg(n.alias("_t"), *[(n - F.count(F.col(c))).alias(c) for c in df.columns]) \
              .unpivot(["_t"], df.columns, "column", "n_null") \
              .select("column", round_half_even(F.col("n_null") / F.col("_t") * 100, 1).alias("pct_null"))
    named = spark.createDataFrame(pairs, "role string, column string").join(nulls, "column")
    high = nulls.where(F.col("pct_null") > high_null).select(F.lit("high_null").alias("role"), "column", "pct_null")
    return named.select("role", "column", "pct_null").unionByName(high)


def code_uniqueness(clean: DataFrame) -> DataFrame:
    """Distinct short local codes vs distinct full area codes (clean table):
    the short code alone does not identify an area."""
    return clean.agg(F.count_distinct("local_code").cast("bigint").alias("local_codes"),
                     F.count_distinct("area_code").cast("bigint").alias("area_codes"))


def codes_with_several_names(clean: DataFrame) -> DataFrame:
    """Area codes that appear under more than one (region, local) spelling:
    the index keys areas by code and names, so each spelling becomes its own
    area row — this check makes that visible (smallest and largest spelling
    shown, the count is exact)."""
    named = clean.where(F.col("area_code").isNotNull() & F.col("region_name").isNotNull()
                        & F.col("local_name").isNotNull())
    name = F.concat_ws(" / ", "region_name", "local_name")
    per = named.groupBy("area_code").agg(
        F.count_distinct("region_name", "local_name").cast("bigint").alias("n_names"),
        F.min(name).alias("first_name"), F.max(name).alias("last_name"))
    return per.where(F.col("n_names") > 1)


def regions_sharing_code(clean: DataFrame, code: str = "001", n: int = 8) -> DataFrame:
    """Sample of areas in different regions that share one short local code."""
    from ..functions.core import zfill
    return (clean.where(zfill("local_code", 3) == code)
                 .select("region_code", "region_name", "area_code", "local_name")
                 .distinct().orderBy(*[F.col(c).asc_nulls_last()
                                        for c in ("area_code", "region_name", "local_name")])
                 .limit(n))
