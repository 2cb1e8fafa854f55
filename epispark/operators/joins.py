"""Joins: lookup, population imputation, semi/anti filters.

Lookups are joined without a hint: the planner broadcasts what it knows to be
small, and AQE re-plans on the measured sizes at run time.  Only a top-n list,
whose size is n, is hinted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.core import accent_key, round_half_even

def join_population(areas: DataFrame, population: DataFrame) -> DataFrame:
    """Left equi-join of the area table to the population lookup on code."""
    pop = population.select("area_code", F.col("population").cast("double"))
    return areas.join(pop, "area_code", "left")


def impute_population(areas: DataFrame, cfg: Config | None = None) -> DataFrame:
    """Missing population <- mean known population of the region's areas
    (rounded half-even to 0 dp) <- default."""
    cfg = cfg or Config()
    region_mean = (areas.where(F.col("population").isNotNull())
                        .groupBy("region_name")
                        .agg(round_half_even(F.avg("population"), 0).alias("_region_pop")))
    out = areas.join(region_mean, "region_name", "left")
    return out.withColumn(
        "population",
        F.coalesce(F.col("population"), F.col("_region_pop"),
                   F.lit(float(cfg.default_population)))).drop("_region_pop")


def join_centroids(regions: DataFrame, centroids: DataFrame,
                   region_col: str = "region_name") -> DataFrame:
    """Inner lookup of region -> lon/lat on the accent-stripped key; regions
    without a centroid drop out (they cannot be drawn)."""
    cen = centroids.groupBy(accent_key("region_key").alias("_key")) \
                   .agg(F.min(F.struct("lon", "lat")).alias("_p")) \
                   .select("_key", "_p.lon", "_p.lat")               # one point per key
    return regions.withColumn("_key", accent_key(region_col)) \
                  .join(cen, "_key", "inner").drop("_key")


def semi_join_top(cases: DataFrame, top: DataFrame, key: str) -> DataFrame:
    """Keep case rows whose key is among a top-n list (n rows: broadcast)."""
    return cases.join(F.broadcast(top.select(key)), key, "left_semi")


def anti_join_new(new: DataFrame, base: DataFrame, key: str = "case_id") -> DataFrame:
    """One row for each id of the new file that is not stored: null ids count
    as one id, and of an id that comes twice the first row stays."""
    from .update import SOURCE_COL, first_rows
    first = first_rows(new.withColumn(SOURCE_COL, F.lit(1)), key)
    stored = base.select(F.col(key).alias("_stored")).distinct()
    return first.join(stored, F.col(key).eqNullSafe(F.col("_stored")), "left_anti")
