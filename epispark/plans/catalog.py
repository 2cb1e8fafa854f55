"""Query catalogue: every registered query as ``(spark, sf_dir) -> DataFrame``.

Inputs are the stand-in tables built from the driver's parquet files (see
``sources.adapter``); every query runs the library's operators over the
whole tables.  Shared stages (clean cases, index) are built once per
session and directory.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..config import Config
from ..operators import clean as CL
from ..operators import index as IX
from ..session import scratch_path
from ..sources import adapter
from ..sources.cases import conform

# the stand-in line list spans several years: queries read all of them; only
# those whose feature is the year rule (scope filter, its reports, validation) use YEAR_CFG
TEST_CFG = Config(year=None)
YEAR_CFG = Config(year=1998)
FILE_ROWS = 250_000          # of the raw line list's files, at most about

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        fn.query_name = name
        return fn
    return deco


class Inputs:
    """Lazily built shared stages for one (session, directory)."""

    _cache: dict = {}

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: Config = TEST_CFG):
        self.spark, self.sf_dir, self.cfg = spark, sf_dir, cfg
        self._memo = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, cfg: Config = TEST_CFG) -> "Inputs":
        key = (id(spark), spark.sparkContext.applicationId, sf_dir, repr(cfg))
        if key not in cls._cache:
            cls._cache[key] = cls(spark, sf_dir, cfg)
        return cls._cache[key]

    def _get(self, name, build):
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    @property
    def raw(self) -> DataFrame:
        """The raw line list as delivered: built once from the test tables
        and written as a Parquet file set under the shared checkpoint
        folder; every raw-level query reads that file set."""
        def build():
            path = scratch_path(self.spark, "raw_cases")
            # as many files as tasks (the joins' last exchange would leave one), more
            # where they would hold more rows than a task should sort
            orders = self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/orders.parquet").count()
            n = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-orders // FILE_ROWS))
            adapter.raw_cases(self.spark, self.sf_dir).repartition(n, "case_id").write.parquet(path)
            return self.spark.read.parquet(path)
        return self._get("raw", build)

    @property
    def aliases(self) -> DataFrame:
        return self._get("aliases", lambda: adapter.region_aliases(self.spark, self.sf_dir))

    @property
    def population(self) -> DataFrame:
        return self._get("population", lambda: adapter.population(self.spark, self.sf_dir))

    @property
    def centroids(self) -> DataFrame:
        return self._get("centroids", lambda: adapter.region_centroids(self.spark, self.sf_dir))

    @property
    def typed_raw(self) -> DataFrame:
        """The raw file as a typed reader returns it (names trimmed, codes
        kept as text, numbers via try_cast)."""
        return self._get("typed_raw", lambda: conform(CL.trim_column_names(self.raw)))

    @property
    def clean(self) -> DataFrame:
        """Clean case table, written once as Parquet under the shared
        checkpoint folder and re-read (lineage cut, column pruning for every
        later aggregate)."""
        def build():
            path = scratch_path(self.spark, "clean")
            # the de-duplication shuffle already hash-partitions on every column
            # (even files whatever the key skew); AQE sizes the partitions
            CL.clean(self.raw, self.cfg, self.aliases).write.parquet(path)
            return self.spark.read.parquet(path)
        return self._get("clean", build)

    @property
    def clean_year(self) -> DataFrame:
        """Clean case table of the analysis year alone, written once."""
        def build():
            path = scratch_path(self.spark, "clean_year")
            CL.clean(self.raw, YEAR_CFG, self.aliases).write.parquet(path)
            return self.spark.read.parquet(path)
        return self._get("clean_year", build)

    @property
    def cube(self) -> DataFrame:
        """Case cube of the clean table, written as Parquet (shared folder)."""
        from ..operators import cube as CB

        def build():
            path = scratch_path(self.spark, "cube")
            CB.case_cube(self.clean).write.parquet(path)
            return self.spark.read.parquet(path)
        return self._get("cube", build)

    @property
    def areas(self) -> DataFrame:
        return self._get("areas", lambda: IX.area_base(self.clean, self.population, self.cfg))

    @property
    def index(self) -> DataFrame:
        return self._get("index", lambda: IX.priority_index(self.areas, self.cfg))


    @property
    def forest(self) -> DataFrame:
        """Test-set predictions of the forest, fitted once a session."""
        from ..operators import ml as ML
        from ..session import materialize
        return self._get("forest", lambda: materialize(ML.forest_predictions(self.index, self.cfg)))

    @property
    def clusters(self) -> DataFrame:
        """Clustered areas, fitted once a session."""
        from ..operators import ml as ML
        from ..session import materialize
        return self._get("clusters", lambda: materialize(ML.kmeans(self.index, self.cfg)))


def inputs(spark, sf_dir) -> Inputs:
    return Inputs.of(spark, sf_dir)


def portable(df: DataFrame) -> DataFrame:
    """Result columns in engine-neutral form for cross-engine comparison:
    dates as ISO ``yyyy-MM-dd`` text, string arrays joined with ', '."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ", ")
        cols.append(c.alias(f.name))
    return df.select(*cols)


IDX_COLS = ("area_code", "region_name", "local_name", "cases", "cases_h1", "cases_h2",
            "pct_adolescent", "pct_young_adult", "pct_hospitalised", "pct_psychiatric",
            "pct_minor", "pct_female", "pct_rural", "trend", "population", "rate_100k",
            "rate_100k_norm", "pct_adolescent_norm", "trend_norm", "pct_hospitalised_norm",
            "pct_psychiatric_norm", "score", "priority", "rank")


@query("idx_priority")
def idx_priority(spark, sf_dir):
    """Flagship: cases -> area table -> population -> index, class, rank."""
    return inputs(spark, sf_dir).index.select(*IDX_COLS)


def load_all():
    """Import every module that registers queries."""
    from . import queries_more  # noqa: F401
    return QUERIES
