"""Readers and writers for case line lists, lookups and published tables.

Line lists are read with an explicit all-text schema and then cast with
``try_cast``: codes keep their leading zeros and bad values become null
instead of failing the job (Spark runs with ANSI mode on).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Config
from ..functions.core import strip_chars
from ..streaming import commits

# canonical raw types; anything not listed keeps its source type (text from
# CSV).  The case id is not listed: ids may be alphanumeric, and a failed
# cast would turn them into nulls that then merge as one id — callers with
# numeric ids pass ``types={"case_id": "bigint"}``.
RAW_TYPES = {
    "event_code": "int", "epi_year": "int", "epi_week": "int",
    "age": "int", "age_unit": "int", "area_type": "int", "hospital_code": "int",
}
GP_PREFIX = "gp_"


def conform(df: DataFrame, types: dict | None = None) -> DataFrame:
    """Cast known columns to their canonical type with ``try_cast``; risk
    flags (``gp_*``) become int."""
    types = {**RAW_TYPES, **(types or {})}
    cols = []
    for f in df.schema.fields:
        want = types.get(f.name) or ("int" if f.name.startswith(GP_PREFIX) else None)
        if want and f.dataType.simpleString() != want:
            src = F.col(f.name)
            if isinstance(f.dataType, T.StringType):
                src = strip_chars(src)
            cols.append(src.try_cast(want).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


ORDINAL_COL = "_ordinal"


def file_order(df: DataFrame) -> DataFrame:
    """``_ordinal`` as (place of the split, place of the row in it), where it
    held the former: rows compare by it in file order, without a pass."""
    return df.withColumn(ORDINAL_COL, F.struct(F.col(ORDINAL_COL).alias("split"), F.monotonically_increasing_id().alias("row")))


def number_rows(df: DataFrame) -> DataFrame:
    """``df``, read from files, with the number of each row over all files
    (``_ordinal``, from 0): files by path, rows in file order.

    Rows of one split (file, first byte) stand in order in one task, so a row's
    place in its split is the difference of two ids; the splits' sizes are
    counted in a pass that reads no column and added up in file order (a row
    per split)."""
    split = ["_path", "_block"]
    marked = df.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block")) \
               .withColumn("_row", F.monotonically_increasing_id())
    sizes = marked.groupBy(*split).agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_head"))
    before = sizes.select(*split, "_head", (F.sum("_n").over(Window.orderBy(*split)) - F.col("_n")).alias("_before"))
    return marked.join(before, split).withColumn(ORDINAL_COL, F.col("_before") + F.col("_row") - F.col("_head")) \
                 .drop(*split, "_row", "_head", "_before")


def read_cases(spark: SparkSession, path: str, fmt: str = "csv",
               mapping: dict | None = None, columns: list | None = None,
               types: dict | None = None, ordinal: bool = False) -> DataFrame:
    """Read a raw line list (many files in parallel).  ``ordinal`` numbers the
    rows in file order (``number_rows``), for updates that keep the first row.

    ``mapping`` renames source columns to canonical names; ``columns`` is the
    header order for CSV (read all as text, no inference).
    """
    if fmt == "csv":
        reader = spark.read.option("header", "true").option("encoding", "UTF-8")
        if columns:
            schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
            df = reader.schema(schema).csv(path)
        else:
            df = reader.option("inferSchema", "false").csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    if ordinal:
        df = number_rows(df)
    if mapping:
        df = df.select(*[F.col(c).alias(mapping.get(c, c)) for c in df.columns])
    return conform(df, types)


POPULATION_SCHEMA = "area_code string, population double"


def read_population(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Area code -> population.  No bundled list: without a file every area
    falls back to the regional/default imputation."""
    if fmt == "csv":
        df = spark.read.option("header", "true").schema(
            "area_code string, region string, local string, population string").csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    return df.select(F.trim("area_code").alias("area_code"),
                     F.col("population").try_cast("double").alias("population"))


def empty_population(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], POPULATION_SCHEMA)


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_clean(df: DataFrame, path: str, partition_by_year: bool = True) -> None:
    w = df.write.mode("overwrite")
    if partition_by_year and "epi_year" in df.columns:
        w = w.partitionBy("epi_year")
    w.parquet(path)


CLUSTER_BY = ("epi_year", "region_name", "month")


def clustered(df: DataFrame, files: int | None = None, by=CLUSTER_BY) -> DataFrame:
    """Rows in ranges of ``by`` and ordered by it within each, so that the
    smallest and largest values in a file's footer let a reader skip row
    groups.  A hash of the row ends the range key: a region that holds a third
    of all cases is cut into as many ranges as its size asks for.

    Range bounds come from a sample, for which the input is read a second
    time: give it a written table, not a long plan."""
    by = [c for c in by if c in df.columns]
    place = F.xxhash64(*df.columns)
    ranged = df.repartitionByRange(files, *by, place) if files else df.repartitionByRange(*by, place)
    return ranged.sortWithinPartitions(*by)


def write_clustered(df: DataFrame, path: str, files: int | None = None, by=CLUSTER_BY,
                    row_group_bytes: int = 32 << 20, partition_by_year: bool = True) -> None:
    """Write the clean table clustered (see ``clustered``), in row groups of
    about ``row_group_bytes``."""
    w = clustered(df, files, by).write.mode("overwrite").option("parquet.block.size", row_group_bytes)
    if partition_by_year and "epi_year" in df.columns:
        w = w.partitionBy("epi_year")
    w.parquet(path)


RANKING_COLUMNS = ("rank", "region_name", "local_name", "cases", "rate_100k",
                   "pct_adolescent", "trend", "score", "priority")


def write_areas(areas: DataFrame, path: str, ranking_csv: str | None = None, k: int = 5) -> None:
    """Persist the area table (Parquet, for use inside) and the 9-column
    ranking extract, from which areas with fewer than ``k`` cases are left out
    as from everything that is handed on."""
    areas.write.mode("overwrite").parquet(path)
    if ranking_csv:
        areas.where(F.col("cases") >= k).select(*RANKING_COLUMNS).write.mode("overwrite") \
             .option("header", "true").csv(ranking_csv)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def resolve_base(spark: SparkSession, candidates: list[tuple[str, str]],
                 cfg: Config | None = None) -> DataFrame | None:
    """First existing (path, fmt) among accumulated -> clean -> raw, with
    missing event code / year filled in (year from the notification date)."""
    cfg = cfg or Config()
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    for path, fmt in candidates:
        p = jvm_path(path)
        if p.getFileSystem(conf).exists(p):
            df = read_cases(spark, path, fmt)
            if "event_code" not in df.columns:
                df = df.withColumn("event_code", F.lit(cfg.event_code))
            if "epi_year" not in df.columns and "notified_text" in df.columns:
                df = df.withColumn("epi_year", F.year(F.try_to_date(
                    F.col("notified_text"), "yyyy-M-d")))
            return df
    return None


def write_snapshot(df: DataFrame, root: str, version: int) -> str:
    """Write a versioned snapshot: a folder of its own that a record then
    names.  A version that exists, or that another writer takes meanwhile, is
    refused (``commits.Conflict``) and stays as it is."""
    spark = df.sparkSession
    if commits.record_of(spark, root, version) is not None:
        raise commits.Conflict(f"snapshot {version} of {root} exists")
    path = f"{commits.attempt(root, 'writer')}/snapshot={version}"
    df.write.parquet(path)
    try:
        commits.commit(spark, root, {"version": version, "path": path})
    except commits.Conflict:
        commits.discard(spark, path)
        raise
    return path


def read_snapshot(spark: SparkSession, root: str, version: int) -> DataFrame:
    record = commits.record_of(spark, root, version) or {"version": version}
    return spark.read.parquet(commits.folder_of(root.rstrip("/"), record, "snapshot"))
