"""Complementary suppression: second cells hidden so that no hidden count
follows from a published total.

Counts are published on nested levels: national total, regions, areas, cells
of an area.  On each level a row with fewer than ``k`` cases is hidden first.
Where the rows hidden under one parent are one alone, or count fewer than
``k`` together, subtracting the published ones from the parent's total would
give them away; so the smallest published row under that parent is hidden too
(ties by key).  It counts at least ``k``, so one is enough: two rows are then
hidden that count ``k`` or more together.  A row under a hidden parent is
hidden.  A parent all of whose rows are hidden keeps its total, which its own
level protects.

One aggregate per level with partial sums and minima; no window over a parent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .describe import PUBLIC_DIMS, public_cells

REGION = ("region_name",)
AREA = ("area_code", "region_name", "local_name")


def _same(one: str, two: str, keys) -> F.Column:
    """Null-safe equality of the keys of two aliased frames."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{one}.{k}").eqNullSafe(F.col(f"{two}.{k}"))
    return cond


def protect(rows: DataFrame, keys, parent=(), count_col: str = "cases", k: int = 5, hidden_parents: DataFrame | None = None) -> DataFrame:
    """``rows`` (unique on ``keys``) with ``hidden``: ``small`` (under k),
    ``second`` (hidden to protect others), ``parent`` (its parent is hidden), or null."""
    marked = rows.withColumn("hidden", F.when(F.col(count_col) < k, F.lit("small")))
    if hidden_parents is not None:
        gone = hidden_parents.select(*parent).distinct().withColumn("_gone", F.lit(True))
        marked = marked.alias("r").join(gone.alias("g"), _same("r", "g", parent), "left").select(
            "r.*", F.col("g._gone").alias("_gone")).withColumn("hidden", F.when(F.col("_gone"), F.lit("parent")).otherwise(F.col("hidden"))).drop("_gone")
    small = F.col("hidden") == "small"
    order = F.struct(F.col(count_col), *keys)
    lines = marked.groupBy(*parent).agg(
        F.sum(F.when(small, 1).otherwise(0)).alias("h"), F.sum(F.when(small, F.col(count_col)).otherwise(0)).alias("s"),
        F.min(F.when(F.col("hidden").isNull(), order)).alias("next"))
    exposed = lines.where((F.col("h") >= 1) & ((F.col("h") == 1) | (F.col("s") < k)) & F.col("next").isNotNull())
    seconds = exposed.select(*[F.col("next")[c].alias(c) for c in keys]).withColumn("_second", F.lit(True))
    out = marked.alias("r").join(seconds.alias("s"), _same("r", "s", keys), "left")
    return out.select(*[F.col(f"r.{c}") for c in rows.columns],
                      F.when(F.col("s._second"), F.lit("second")).otherwise(F.col("r.hidden")).alias("hidden"))


def protected_areas(areas: DataFrame, k: int = 5) -> DataFrame:
    """The areas (``AREA`` keys and cases) with ``hidden``, as regions and the nation have published totals."""
    regions = protect(areas.groupBy(*REGION).agg(F.sum("cases").alias("cases")), REGION, (), "cases", k)
    return protect(areas, AREA, REGION, "cases", k, regions.where("hidden is not null"))


def protected_cells(cases: DataFrame, areas: DataFrame, k: int = 5, dims=PUBLIC_DIMS) -> DataFrame:
    """The public cells of ``cases`` with ``hidden``; ``areas`` as ``protected_areas`` gave them."""
    return protect_cells(public_cells(cases, dims), areas, k, dims)


def protect_cells(cells: DataFrame, areas: DataFrame, k: int = 5, dims=PUBLIC_DIMS) -> DataFrame:
    """``protected_cells`` of cells that are counted already."""
    return protect(cells, list(dims), AREA, "cases", k, areas.where("hidden is not null"))


def published(rows: DataFrame) -> DataFrame:
    return rows.where("hidden is null").drop("hidden")


def audit(rows: DataFrame, parent, level: str, count_col: str = "cases", k: int = 5) -> DataFrame:
    """Tries to solve for the hidden rows of ``rows`` from the totals of their
    parents and the published rows, as a reader who knows which rows exist
    could: the rest of a total falls to the hidden rows under it, and is known
    where it is one row or fewer than ``k`` cases.  Rows under a hidden parent
    have no total to subtract from (``hidden`` = parent).  One row: how many
    are hidden, how many totals have hidden rows, how many hidden rows follow."""
    open_ = F.col("hidden").isin("small", "second")
    lines = rows.groupBy(*parent).agg(F.sum(F.when(open_, 1).otherwise(0)).alias("h"),
                                      F.sum(F.when(open_, F.col(count_col)).otherwise(0)).alias("s"),
                                      F.sum(F.when(F.col("hidden").isNotNull(), 1).otherwise(0)).alias("all"),
                                      F.sum(F.when(F.col("hidden") == "parent", 1).otherwise(0)).alias("p"), F.sum(count_col).alias("total"))
    # the total itself is not published where it is under k: that protects what it consists of
    known = (F.col("h") >= 1) & (F.col("p") == 0) & (F.col("total") >= k) & ((F.col("h") == 1) | (F.col("s") < k))
    return lines.agg(F.coalesce(F.sum("all"), F.lit(0)).cast("bigint").alias("hidden_rows"),
                     F.sum(F.when(F.col("h") >= 1, 1).otherwise(0)).cast("bigint").alias("totals_with_hidden"),
                     F.coalesce(F.sum(F.when(known, F.col("h"))), F.lit(0)).cast("bigint").alias("solved")) \
                .select(F.lit(level).alias("level"), F.coalesce("hidden_rows", F.lit(0)).alias("hidden_rows"),
                        F.coalesce("totals_with_hidden", F.lit(0).cast("bigint")).alias("totals_with_hidden"), "solved")
