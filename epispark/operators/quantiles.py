"""Exact quantiles by selection, with bounded state.

A quantile needs the values at one or two ranks.  Each pass counts the rows of
a range in bins and goes on with the bin that holds the rank:

* the first pass has a bin for every whole number below ``UNITS`` and bins of
  a 16th of an e-fold beyond (at most some 30,000 bins for all doubles); the
  ranks of all quantiles are found in its counts at once;
* later passes cut the range between the smallest and the largest value of
  the chosen bin into ``BINS`` equal parts.

Bins never overlap, since their formulas do not fall where x rises.  A range
of one value is done; one of at most ``SMALL`` rows is counted by value.  No
state grows with the number of different values; rows are scanned once a pass, one pass
for whole numbers such as ages, and counted in the tasks before they are
shuffled.  The interpolation is the linear rule of ``percentile``.  Infinite
values are the outermost ones, NaN comes after all others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

UNITS = 2048                # whole numbers below it have a bin of their own
BINS = 4096
SMALL = 10_000              # rows of a range that are counted by value at the end
TARGETS = 10_000            # (group, rank) rows up to which they are broadcast


def _meet(rows: DataFrame, targets: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` with the columns of the targets of their group (null keys are
    equal); targets are broadcast if they are few."""
    other = targets.withColumnsRenamed({c: f"_of_{c}" for c in by})
    if targets.limit(TARGETS + 1).count() <= TARGETS:
        other = F.broadcast(other)
    return rows.join(other, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]).drop(*[f"_of_{c}" for c in by])


def _chosen(counts: DataFrame, by: list[str]) -> DataFrame:
    """Of (by, rank, rem, bin, n, lo, hi): the bin with the row ``rem`` of each (by, rank)."""
    order = Window.partitionBy(*by, "rank").orderBy("bin")
    upto = counts.withColumn("upto", F.sum("n").over(order))
    return upto.where((F.col("upto") > F.col("rem")) & (F.col("upto") - F.col("n") <= F.col("rem"))) \
               .select(*by, "rank", "lo", "hi", (F.col("rem") - F.col("upto") + F.col("n")).alias("rem"), "n")


def _size(values: DataFrame) -> Column:
    """How many rows there are: records, or the sum of their weights ``w``."""
    return F.sum("w") if "w" in values.columns else F.count(F.lit(1))


def first_bin(x: Column) -> Column:
    """The bin of a number in the first pass."""
    size = F.abs(x)
    fold = F.floor(F.least((F.log1p(size) - F.log1p(F.lit(float(UNITS)))) * 16, F.lit(20_000.0))).cast("int")
    return (F.when(F.isnan(x), F.lit(1 << 30)).when(size <= UNITS, F.floor(x).cast("int"))
            .when(x > 0, F.lit(UNITS + 1) + fold).otherwise(F.lit(-UNITS - 1) - fold))


def _placed(values: DataFrame, probs: Sequence[float], by: list[str]) -> DataFrame:
    """(by, i, at, rank, rem, n, lo, hi): for the two ranks next to the place
    ``at`` of each quantile, the first-pass bin that holds the rank, as its
    ``rem``-th row of ``n``."""
    first = values.groupBy(*by, first_bin(F.col("x")).alias("bin")).agg(
        _size(values).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    group = Window.partitionBy(*by)
    counts = first.withColumn("upto", F.sum("n").over(group.orderBy("bin"))).withColumn("size", F.sum("n").over(group))
    at = [(F.col("size") - 1) * F.lit(float(p)) for p in probs]
    places = F.array(*[F.struct(F.lit(i).alias("i"), a.alias("at"), end(a).alias("rank"))
                       for i, a in enumerate(at) for end in (F.floor, F.ceil)])
    start = F.col("upto") - F.col("n")
    here = F.filter(places, lambda e: (e["rank"] >= start) & (e["rank"] < F.col("upto")))
    return (counts.select(*by, start.alias("start"), "n", "lo", "hi", F.explode(here).alias("p"))
            .select(*by, "p.i", "p.at", "p.rank", (F.col("p.rank") - F.col("start")).alias("rem"), "n", "lo", "hi"))


def order_statistics(values: DataFrame, left: DataFrame, by: list[str]) -> DataFrame:
    """(by, rank, x): the value at each rank of ``left`` (by, rank, rem, n, lo,
    hi), row ``rem`` (from 0) among the ``n`` rows of ``values`` (by, x) from
    lo to hi."""
    x = F.col("x")
    found = left.where("lo = hi").select(*by, "rank", F.col("lo").alias("x"))
    while True:
        left = left.where("lo < hi")
        big = left.where(F.col("n") > SMALL)
        if left.isEmpty():
            return found
        if big.isEmpty():
            break
        part = F.least(F.floor((x - F.col("lo")) / (F.col("hi") - F.col("lo")) * BINS), F.lit(BINS - 1))
        inside = _meet(values, left.drop("n"), by).where((x >= F.col("lo")) & (x <= F.col("hi")))
        counts = inside.groupBy(*by, "rank", "rem", part.alias("bin")).agg(
            _size(values).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        left = materialize(_chosen(counts, by))
        found = found.unionByName(left.where("lo = hi").select(*by, "rank", F.col("lo").alias("x")))
    inside = _meet(values, left.drop("n"), by).where((x >= F.col("lo")) & (x <= F.col("hi")))
    last = inside.groupBy(*by, "rank", "rem", x.alias("bin")).agg(
        _size(values).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))      # SMALL values at most
    return found.unionByName(_chosen(last, by).select(*by, "rank", F.col("lo").alias("x")))


def quantiles_by(df: DataFrame, value: str | Column, probs: Sequence[float], by: Sequence[str | Column] = (),
                 weight: str | None = None) -> DataFrame:
    """(by, q): exact quantiles of each group as an array in the order of
    ``probs``; groups without a value have no row, null keys are a group.  A
    record with a ``weight`` (a whole number) stands for as many rows, with
    none or 0 for no row."""
    v = F.col(value) if isinstance(value, str) else value
    keys = [F.col(b) if isinstance(b, str) else b for b in by]
    names = df.select(*keys).columns if keys else []
    group = [f"_key_{i}" for i in range(max(1, len(keys)))]     # no clash with the columns made here
    counted = [F.col(weight).cast("bigint").alias("w")] if weight else []
    rows = df.select(*[c.alias(g) for c, g in zip(keys or [F.lit(0)], group)], v.cast("double").alias("x"), *counted).where("x is not null")
    if weight:
        rows = rows.where("w > 0")
    rows = rows.withColumn("x", F.when(F.col("x") == 0, 0.0).otherwise(F.col("x")))
    placed = materialize(_placed(rows, probs, group))           # two rows a group and quantile
    if placed.where("lo < hi").isEmpty():
        values = placed.withColumn("x", F.col("lo"))
    else:
        ranks = placed.select(*group, "rank", "rem", "n", "lo", "hi").distinct()
        found = order_statistics(rows, ranks, group).withColumnRenamed("rank", "_of_rank")
        values = _meet(placed, found, group).where(F.col("rank") == F.col("_of_rank"))
    # the value at the lower rank is the smaller one
    both = values.groupBy(*group, "i", "at").agg(F.min("x").alias("a"), F.max("x").alias("b"))
    low, high = F.floor("at"), F.ceil("at")
    q = F.when(low == high, F.col("a")).otherwise((high - F.col("at")) * F.col("a") + (F.col("at") - low) * F.col("b"))
    out = both.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("i", q.alias("q")))).alias("s"))
    return out.select(*[F.col(g).alias(c) for g, c in zip(group, names)], F.transform("s", lambda e: e["q"]).alias("q"))
