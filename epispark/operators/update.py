"""Incremental update: merge a new line-list file into the stored base.

The merged table keeps one row per case id with the stored row winning.

* ``merge`` (general form, any base): de-duplication is a
  ``groupBy(case_id)`` with ``min_by`` — a partial aggregate, so a hot id (or
  the null-id group, which pandas-style de-duplication treats as one id)
  collapses map-side before the shuffle, instead of a window that would sort
  the whole hot group in one task.
* ``new_rows`` (incremental form, base already unique on the id — true of
  every table ``merge`` produced): only the incoming file is de-duplicated;
  the ids it shares with the base are found by scanning the base's id column
  against the incoming ids (the planner picks the join on measured sizes),
  and only the remaining rows are appended.  The stored rows are not
  rewritten.  Ids match null-safely.

"First" is the order of the file where its reader numbered the rows
(``_ordinal``, see ``sources.cases.read_cases``); else the smallest row, which
no partitioning can change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .joins import anti_join_new

SOURCE_COL = "_source"        # 0 = stored base, 1 = new file
ORDINAL_COL = "_ordinal"      # place of the row in its file, if known


def union_update(base: DataFrame, new: DataFrame) -> DataFrame:
    """Append by column name; columns missing on either side become null."""
    return base.withColumn(SOURCE_COL, F.lit(0)).unionByName(
        new.withColumn(SOURCE_COL, F.lit(1)), allowMissingColumns=True)


REPEATED = 100_000            # ids that come more than once, up to which they are broadcast


def first_rows(tagged: DataFrame, key: str = "case_id") -> DataFrame:
    """The rows of ``dedup_first``, for files in which most ids come once.

    Ids are counted first, in a pass that reads the id alone.  A row whose id
    comes once is the first of it: where few ids come more than once, only
    their rows are compared, and no other row is sorted or shuffled."""
    cols = [c for c in tagged.columns if c not in (SOURCE_COL, ORDINAL_COL)]
    cols = [key, *[c for c in cols if c != key]]
    again = materialize(tagged.groupBy(F.col(key).alias("_again")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_again"))
    found = again.limit(REPEATED + 1).count()
    if not found:
        return tagged.select(*cols)
    if found > REPEATED:
        return dedup_first(tagged, key)
    few = F.broadcast(again)
    same = F.col(key).eqNullSafe(F.col("_again"))
    once = tagged.join(few, same, "left_anti").select(*cols)
    return once.unionByName(dedup_first(tagged.join(few, same, "left_semi"), key))


def dedup_first(tagged: DataFrame, key: str = "case_id") -> DataFrame:
    """One row per key: the stored base wins over the new file; within one
    source the first row (see above).  The ordinal is left out of the result.
    All rows are compared, in one shuffle."""
    cols = [c for c in tagged.columns if c not in (key, SOURCE_COL, ORDINAL_COL)]
    row = F.struct(*[F.col(c) for c in cols])
    place = [F.col(ORDINAL_COL)] if ORDINAL_COL in tagged.columns else []
    order = F.struct(F.col(SOURCE_COL).alias("s"), *place, row.alias("r"))
    best = tagged.groupBy(key).agg(F.min_by(row, order).alias("_row"))
    return best.select(key, *[F.col("_row")[c].alias(c) for c in cols])


def merge(base: DataFrame, new: DataFrame, key: str = "case_id") -> DataFrame:
    return dedup_first(union_update(base, new), key)


def merge_by_anti_join(base: DataFrame, new: DataFrame, key: str = "case_id") -> DataFrame:
    """Equivalent plan when the base is already unique on the key (null
    counting as one key): base + (new rows whose key is not stored)."""
    return base.unionByName(anti_join_new(new, base, key), allowMissingColumns=True)


def existing_ids(base: DataFrame, new: DataFrame, key: str = "case_id") -> DataFrame:
    """Incoming ids already stored (null-safe), reading only the base id column."""
    ids = new.select(F.col(key).alias("_k")).distinct()
    b = base.select(F.col(key).alias("_b"))
    return b.join(ids, F.col("_b").eqNullSafe(F.col("_k")), "left_semi").select(F.col("_b").alias(key)).distinct()


def new_rows(base: DataFrame, new: DataFrame, key: str = "case_id") -> DataFrame:
    """Rows to append so that base + result equals ``merge(base, new)``,
    given a base that is unique on ``key``."""
    first = first_rows(new.withColumn(SOURCE_COL, F.lit(1)), key)
    seen = existing_ids(base, new, key).withColumnRenamed(key, "_seen")
    return first.join(seen, F.col(key).eqNullSafe(F.col("_seen")), "left_anti")


def update_report(base: DataFrame, new: DataFrame, key: str = "case_id") -> DataFrame:
    """Existing rows, new rows, rows dropped as duplicates and rows really
    added (negative when the base itself had duplicate ids)."""
    tagged = union_update(base.select(key), new.select(key))
    per_key = tagged.groupBy(key).agg(F.count(F.lit(1)).alias("_n"),
                                      F.sum(1 - F.col(SOURCE_COL)).alias("_nb"))
    t = per_key.agg(F.sum("_nb").cast("bigint").alias("existing"),
                    F.sum(F.col("_n") - F.col("_nb")).cast("bigint").alias("incoming"),
                    F.count(F.lit(1)).cast("bigint").alias("merged"))
    return t.select("existing", "incoming",
                    (F.col("existing") + F.col("incoming") - F.col("merged"))
                    .alias("duplicates"),
                    (F.col("merged") - F.col("existing")).alias("added"))
