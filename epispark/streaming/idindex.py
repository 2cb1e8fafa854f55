"""Index of stored case ids: a bucketed table next to the batch table.

    <root>/_ids/attempt=<name of a batch's folder>/   its ids, in buckets by hash

An update joins its ids to this table without shuffling the stored side: only
the incoming ids are dealt into the same buckets.  Rows of attempts that were
never committed are left out, as the caller names the committed folders.  Null
ids are not in the index; commit records say whether one is stored.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import commits

BUCKETS = 64          # for a new table; about one per 10 million ids serves


def _meta(spark: SparkSession, root: str, key_type: str | None, buckets: int) -> dict | None:
    p, fs = commits._path(spark, f"{root}/_manifest/ids.meta")
    if not fs.exists(p):
        if key_type is None:
            return None
        try:
            commits.create(spark, root, "ids.meta", {"type": key_type, "buckets": buckets})
        except commits.Conflict:
            pass
    return commits._load(spark, fs, p)


def attempt_of(folder: str) -> str:
    """The name of a batch's folder as a partition value: ``batch=3-ab12`` is ``3-ab12``."""
    return folder.rstrip("/").rsplit("/", 1)[-1].split("=")[-1]


def _table(spark: SparkSession, root: str, meta: dict) -> str:
    """The index as a table of this session, with the folders that are there now."""
    name = "ids_" + hashlib.md5(root.encode()).hexdigest()[:16]
    p, fs = commits._path(spark, f"{root}/_ids")
    fs.mkdirs(p)
    where = f"{root}/_ids".replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (id {meta['type']}, attempt string) USING parquet PARTITIONED BY (attempt) "
              f"CLUSTERED BY (id) INTO {meta['buckets']} BUCKETS LOCATION '{where}'")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)
    return name


def add(ids: DataFrame, root: str, folder: str, key: str, buckets: int = BUCKETS) -> None:
    """Add the non-null ids of the batch written to ``folder``."""
    spark = ids.sparkSession
    meta = _meta(spark, root, ids.schema[key].dataType.simpleString(), buckets)
    name = "ids_" + uuid.uuid4().hex
    # a table of this batch alone, in its own folder: writers do not meet
    (ids.select(F.col(key).cast(meta["type"]).alias("id")).where("id is not null").repartition(meta["buckets"], "id")
     .write.bucketBy(meta["buckets"], "id").option("path", f"{root}/_ids/attempt={attempt_of(folder)}").saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")             # the files stay


def stored(spark: SparkSession, root: str, folders: list[str]) -> tuple[DataFrame, dict] | None:
    """(ids of the batches in ``folders``, description of the index), if there is one."""
    meta = _meta(spark, root, None, 0)
    if meta is None:
        return None
    names = [attempt_of(f) for f in folders]
    return spark.table(_table(spark, root, meta)).where(F.col("attempt").isin(names)).select("id"), meta


def unseen(first: DataFrame, ids: DataFrame, meta: dict, key: str) -> DataFrame:
    """Rows of ``first`` (unique on ``key``) with a non-null id that is not
    stored.  Only ``first`` is shuffled, into the buckets of the index."""
    some = first.where(F.col(key).isNotNull()).withColumn(key, F.col(key).cast(meta["type"]))
    return some.repartition(meta["buckets"], key).join(ids, F.col(key) == F.col("id"), "left_anti")
