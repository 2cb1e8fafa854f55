"""Small-cell suppression at every publish boundary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import count_if
from .describe import PUBLIC_DIMS, public_cells

CASE_LEVEL_COLUMNS = ("case_id", "notified_on", "onset_on", "born_on", "age", "notified_text",
                      "onset_text", "born_text")


def suppress(df: DataFrame, count_col: str = "cases", k: int = 5) -> DataFrame:
    """Keep only rows whose count is at least k."""
    return df.where(F.col(count_col) >= k)


def public_top_areas(cases: DataFrame, k: int = 5, top: int = 20) -> DataFrame:
    """Areas by cases with cells under k suppressed first, then the top n
    (ties: code, names) — suppression before the limit, so n rows show
    whenever n areas qualify."""
    from .describe import by_area
    keys = ("area_code", "region_name", "local_name")
    allowed = suppress(by_area(cases, None), "cases", k)
    return allowed.orderBy(F.col("cases").desc(), *keys).limit(top)


def public_areas(idx: DataFrame, k: int = 5) -> DataFrame:
    return suppress(idx, "cases", k)


def public_areas_report(idx: DataFrame, k: int = 5) -> DataFrame:
    return idx.agg(F.count(F.lit(1)).cast("bigint").alias("areas_before"),
                   count_if(F.col("cases") >= k).alias("areas_published"),
                   count_if(F.col("cases") < k).alias("areas_suppressed"))


def public_case_cells(cases: DataFrame, k: int = 5, dims=PUBLIC_DIMS) -> DataFrame:
    return suppress(public_cells(cases, dims), "cases", k)


def k_anonymity_check(published: DataFrame, count_col: str = "cases", k: int = 5) -> DataFrame:
    """One row: smallest cell, number of cells, case-level columns present,
    and whether the frame is safe to publish.  A frame without cells holds
    nothing to protect and is safe; ``n_cells`` tells it apart."""
    forbidden = [c for c in published.columns if c in CASE_LEVEL_COLUMNS]
    arr = F.array(*[F.lit(c) for c in forbidden]) if forbidden \
        else F.array().cast("array<string>")
    t = published.agg(F.min(count_col).cast("bigint").alias("min_cell"),
                      F.count(F.lit(1)).cast("bigint").alias("n_cells"))
    return t.select("min_cell", "n_cells", F.size(arr).alias("n_case_level_columns"),
                    (F.coalesce(F.col("min_cell") >= k, F.lit(True)) & (F.size(arr) == 0))
                    .alias("is_safe"))
