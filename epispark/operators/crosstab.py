"""Cross tabulations: margins are exactly ``cube`` (long form, with
``grouping_id`` to tell a total row from a null key); the wide form is a
``pivot`` over an explicit value list (no extra distinct job)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import derive as D
from .joins import semi_join_top

TOTAL = "Total"
SEX_VALUES = (C.SEX_LABELS["F"], C.SEX_LABELS["M"], C.SEX_DEFAULT)
SEX_COLUMNS = ("n_female", "n_male", "n_other")


def crosstab_cube(df: DataFrame, row: str, col: str) -> DataFrame:
    """Counts for every (row, col) cell plus row, column and grand totals."""
    f = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    t = f.cube(row, col).agg(F.count(F.lit(1)).cast("bigint").alias("cases"),
                             F.grouping_id().cast("int").alias("grouping_id"))
    return t.select(
        F.when(F.col("grouping_id").bitwiseAND(2) == 2, F.lit(TOTAL))
         .otherwise(F.col(row).cast("string")).alias(row),
        F.when(F.col("grouping_id").bitwiseAND(1) == 1, F.lit(TOTAL))
         .otherwise(F.col(col).cast("string")).alias(col),
        "cases", "grouping_id")


def age_by_sex(df: DataFrame) -> DataFrame:
    return crosstab_cube(df, "age_group", "sex_label")


def top_regions(df: DataFrame, n: int = 10) -> DataFrame:
    return (df.where(F.col("region_name").isNotNull()).groupBy("region_name")
              .agg(F.count(F.lit(1)).alias("_n"))
              .orderBy(F.col("_n").desc(), "region_name").limit(n).select("region_name"))


def region_by_sex(df: DataFrame, n: int = 10) -> DataFrame:
    """Top-n regions by cases x sex with totals; the top list (n rows) is
    broadcast into a left-semi join over the case rows."""
    return crosstab_cube(semi_join_top(df, top_regions(df, n), "region_name"),
                         "region_name", "sex_label")


def month_by_sex(df: DataFrame, values=SEX_VALUES, names=SEX_COLUMNS) -> DataFrame:
    """Month x sex counts, zero-filled, no totals (wide; one column per
    listed value, named by ``names``)."""
    f = df.where(F.col("month").isNotNull() & F.col("sex_label").isNotNull())
    wide = f.groupBy("month").pivot("sex_label", list(values)).agg(F.count(F.lit(1)))
    return wide.select("month", D.month_name("month", short=True).alias("month_name"),
                       *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).cast("bigint").alias(n)
                         for v, n in zip(values, names)])
