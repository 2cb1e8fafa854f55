"""Data behind the figures (drawing itself is out of scope)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import count_if
from .quantiles import quantiles_by


def histogram(df: DataFrame, col: str = "age", bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed (numpy rule: edges
    are ``min + i * (max - min) / bins``, a value on an inner edge belongs to
    the bin on its right).  Empty bins are kept with 0."""
    x = F.col(col).cast("double")
    st = df.select(F.struct(F.min(x).alias("mn"), F.max(x).alias("mx"))).scalar()
    mn, mx = st["mn"], st["mx"]
    step = (mx - mn) / F.lit(float(bins))

    def edge(i):
        return F.when(i >= bins, mx).otherwise(i * step + mn)

    # values are counted first; a value's bin is guessed and moved by one where an edge says so
    v, k = F.col("v"), F.col("bin")
    counts = (df.where(x.isNotNull()).groupBy(x.alias("v")).agg(F.count(F.lit(1)).alias("n"))
              .withColumn("bin", F.when(mx == mn, F.lit(0)).otherwise(
                  F.least(F.floor((v - mn) / (mx - mn) * bins).cast("int"), F.lit(bins - 1))))
              .withColumn("bin", F.when(v < edge(k), k - 1).otherwise(k))
              .withColumn("bin", F.when((v >= edge(k + 1)) & (k != bins - 1), k + 1).otherwise(k))
              .groupBy("bin").agg(F.sum("n").alias("cases")))
    # the bins without rows come from a range of `bins` rows
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = every.join(counts, "bin", "left").withColumn("cases", F.coalesce("cases", F.lit(0)))
    b = F.col("bin")
    return out.select(
        (b + 1).cast("int").alias("bin"),
        F.when(mx == mn, mn).otherwise(b * step + mn).alias("lo"),
        F.when(b + 1 >= bins, mx).otherwise((b + 1) * step + mn).alias("hi"),
        F.col("cases").cast("bigint").alias("cases"))


def center_lines(df: DataFrame, col: str = "age") -> DataFrame:
    x = F.col(col).cast("double")
    median = quantiles_by(df, x, (0.5,)).select(F.col("q")[0]).scalar()
    return df.agg(F.avg(x).alias("mean")).select("mean", median.alias("median"))


def boxplot(df: DataFrame, col: str = "age", by: str = "sex",
            groups=("F", "M")) -> DataFrame:
    """Per group: quartiles (linear), whiskers = furthest points within
    1.5 IQR of the box, and the count of points beyond them.  Quartiles are
    selected per group and joined back (a row for each of ``groups``)."""
    x = F.col(col).cast("double")
    f = df.where(F.col(by).isin(*groups) & x.isNotNull())
    q = quantiles_by(f, x, (0.25, 0.5, 0.75), [by])
    q = q.select(by, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
                 F.col("q")[2].alias("q3"))
    j = f.join(F.broadcast(q), by)
    iqr = F.col("q3") - F.col("q1")
    lo, hi = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    return j.groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(x >= lo, x)).alias("whisker_lo"),
        F.max(F.when(x <= hi, x)).alias("whisker_hi"),
        count_if((x < lo) | (x > hi)).alias("outliers"),
        F.count(F.lit(1)).cast("bigint").alias("n"))
