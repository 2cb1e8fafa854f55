"""Session construction and lineage cutting.

On a cluster the session already carries ``spark.checkpoint.dir`` (a shared
folder); we read it from the session and only fall back to a fresh scratch
folder when it is unset (local tests).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app: str = "epispark", **conf) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    for k, v in {**_DEFAULTS, "spark.sql.shuffle.partitions": str(shuffle_partitions),
                 **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, partition_bytes: int = 256 << 20) -> dict:
    """Settings for a cluster run over ``input_bytes`` of line lists: initial
    shuffle partitions sized so every reducer gets ~``partition_bytes`` of the
    largest shuffle (the full-row de-duplication moves about the input size);
    AQE then coalesces small ones and splits skewed ones."""
    parts = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(2 * partition_bytes),
        "spark.sql.parquet.filterPushdown": "true",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint folder, creating a scratch
    one only when the session names none (local runs)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...): "
                               "lineage cuts must survive the loss of any machine")
        configured = tempfile.mkdtemp(prefix="epispark-ckpt-")   # local runs only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Used on small aggregates (area table) that several later steps scan, so
    the expensive case-level aggregation runs once and a lost executor never
    forces it to be recomputed from the raw files.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"
