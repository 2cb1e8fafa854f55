"""Stand-in inputs built from the driver's TPC-H-like tables.

These builders only produce rows in the schema the operators expect (a raw
case line list, a population lookup, a region alias lookup); they do none of
the analysis.  The mapping is the one documented in FIXTURES.md §5: one order
is one notified case, the customer's nation is the region and its market
segment the local area; dirty values are injected by key arithmetic so the
cleaning operators have something to clean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES: market segment -> local code (FIXTURES.md §5)
SEGMENT_CODES = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4,
                 "MACHINERY": 5}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _segment_code(c):
    kv = []
    for k, v in SEGMENT_CODES.items():
        kv += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*kv), c)


def raw_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw (uncleaned) case line list: one row per order."""
    orders = _table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority")
    customer = _table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment") \
        .withColumn("seg", _segment_code(F.col("c_mktsegment")))
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    first_ship = _table(spark, sf_dir, "lineitem").groupBy("l_orderkey") \
        .agg(F.min("l_shipdate").alias("first_ship"))

    # every order is a case, also one without a known customer, nation or segment
    j = (orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
               .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
               .join(first_ship, F.col("o_orderkey") == F.col("l_orderkey"), "left"))

    k = F.col("o_orderkey")
    ck = F.col("o_custkey")
    yr = F.year("o_orderdate")
    age = F.floor("o_totalprice").cast("bigint") % 95
    born_year = (yr - age - F.when(k % 211 == 0, 5).otherwise(0)).cast("int")
    born = F.make_date(born_year, (1 + k % 12).cast("int"), (1 + k % 28).cast("int"))
    name = F.col("n_name")
    return j.select(
        k.alias("case_id"),
        F.lit(356).alias("event_code"),
        F.lit("case").alias("event_name"),
        yr.alias("epi_year"),
        F.weekofyear("o_orderdate").alias("epi_week"),
        F.col("o_orderdate").cast("date").cast("string").alias("notified_text"),
        F.when(k % 101 == 0, F.lit("bad"))
         .otherwise(F.col("first_ship").cast("date").cast("string")).alias("onset_text"),
        born.cast("string").alias("born_text"),
        age.alias("age"),
        F.lit(1).alias("age_unit"),
        F.when(k % 89 == 0, "f").when(F.col("o_orderstatus") == "F", "F")
         .when(F.col("o_orderstatus") == "O", "M").when(k % 50 == 0, "X")
         .when(k % 2 == 0, "F").otherwise("M").alias("sex"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("area_type"),
        F.when(ck % 3 == 0, 1).otherwise(2).alias("hospital_code"),
        F.col("n_nationkey").cast("string").alias("region_code"),
        F.col("seg").cast("string").alias("local_code"),
        F.when(F.col("n_nationkey") == 24, F.lit("EXTERIOR"))
         .when(k % 997 == 0, F.lit(None).cast("string"))
         .when(k % 4 == 1, F.lower(name))
         .when(k % 4 == 2, F.concat(F.lit("  "), name, F.lit(" ")))
         .when(k % 4 == 3, F.replace(name, F.lit("_"), F.lit(" ")))
         .otherwise(name).alias("region_name"),
        F.col("c_mktsegment").alias("local_name"),
        F.when(ck % 7 == 0, 1).otherwise(2).alias("gp_psychiatric"),
        F.when(ck % 11 == 0, 1).otherwise(2).alias("gp_migrant"),
        F.when(ck % 13 == 0, 1).otherwise(2).alias("gp_pregnant"),
        F.when(k % 3 == 0, F.lit("   "))
         .otherwise(F.concat(F.lit(" g"), (ck % 4).cast("string"))).alias("group_name"),
        F.when(k % 5 == 0, F.lit(" ")).when(k % 77 == 0, F.lit("n/a"))
         .otherwise(F.concat((1 + ck % 6).cast("string"), F.lit("  "))).alias("stratum"),
    )


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area code -> population for part of the (nation, segment) areas."""
    nation = _table(spark, sf_dir, "nation").select("n_nationkey")
    segs = F.explode(F.array(*[F.lit(v) for v in sorted(SEGMENT_CODES.values())]))
    grid = nation.select("n_nationkey", segs.alias("seg"))
    n, s = F.col("n_nationkey"), F.col("seg")
    return grid.where(((n * 5 + s) % 3 != 0) & (n % 10 != 9)).select(
        F.concat(F.lpad(n.cast("string"), 2, "0"), F.lpad(s.cast("string"), 3, "0"))
         .alias("area_code"),
        (F.lit(20000) + F.lit(1000) * ((n * 7 + s * 13) % 50)).cast("double")
         .alias("population"))


def region_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variant spelling -> canonical region name (space for underscore)."""
    nation = _table(spark, sf_dir, "nation").select("n_name")
    return nation.select(
        F.upper(F.replace(F.col("n_name"), F.lit("_"), F.lit(" "))).alias("variant"),
        F.upper(F.col("n_name")).alias("canonical"))


def region_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region key -> lon/lat, from the nation and region keys."""
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return nation.where(F.col("n_nationkey") % 8 != 5).select(
        F.upper(F.col("n_name")).alias("region_key"),
        (F.lit(-80.0) + F.col("n_nationkey") * 0.5).alias("lon"),
        (F.lit(-4.0) + F.col("n_regionkey") * 3.0).alias("lat"))
