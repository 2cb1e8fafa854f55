"""Window operators.  Unpartitioned windows run only over aggregates with a
proven bound (<= 53 epidemiological weeks, <= 10,001 rounded scores);
per-region picks use partial aggregation (``min_by``) instead of a window
so a region holding a third of the areas is not sorted in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.core import round_half_even
from .index import with_rank  # noqa: F401  (national rank lives with the index)


def weekly_trend(df: DataFrame, window: int = 4, digits: int | None = 1) -> DataFrame:
    """Cases per week and the trailing mean over the last ``window`` rows
    present (missing weeks are skipped, not zero-filled)."""
    t = df.where(F.col("epi_week").isNotNull()).groupBy("epi_week") \
          .agg(F.count(F.lit(1)).cast("bigint").alias("cases"))
    w = Window.orderBy("epi_week").rowsBetween(-(window - 1), 0)   # <= 53 rows
    ma = F.avg("cases").over(w)
    return t.withColumn("moving_avg", round_half_even(ma, digits) if digits is not None else ma)


def peak_week(df: DataFrame) -> DataFrame:
    """Week with most cases (ties -> earliest week)."""
    t = df.where(F.col("epi_week").isNotNull()).groupBy("epi_week") \
          .agg(F.count(F.lit(1)).alias("cases"))
    return t.agg(F.max_by("epi_week", F.struct("cases", -F.col("epi_week"))).alias("epi_week"),
                 F.max("cases").cast("bigint").alias("cases"))


def region_mean_population(areas: DataFrame) -> DataFrame:
    """Each area with the mean known population of its region's areas."""
    reg = areas.where(F.col("population").isNotNull()).groupBy("region_name") \
               .agg(F.avg("population").alias("region_mean_pop"))
    return areas.join(reg, "region_name", "left")


def top_area_per_region(idx: DataFrame) -> DataFrame:
    """Highest-index area in each region (ties -> smallest code)."""
    best = F.min_by(F.struct("area_code", "local_name", "score", "priority"),
                    F.struct((-F.col("score")).alias("s"), F.col("area_code").alias("c"),
                             F.col("local_name").alias("l")))
    return idx.groupBy("region_name").agg(best.alias("b")).select(
        "region_name", "b.area_code", "b.local_name", "b.score", "b.priority")
