"""Session and shared-storage helpers.

Spark settings here are the ones the library relies on for correctness
(UTC session time zone, ANSI casts) plus scale defaults (AQE with skew-join
and partition coalescing).  Shared folders are always derived from the
cluster's ``spark.checkpoint.dir``; a private temporary folder is created
only for a local-mode session that has none configured (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, app: str = "pricelake",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_session_settings(spark)
    return spark


def scale_settings(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Sizing for a run over ``input_bytes`` of input: AQE can only coalesce
    shuffle partitions, never split them, so the initial count must already
    give partitions of about ``target_partition_bytes``; scan splits and the
    AQE advisory size use the same target, and skewed partitions (a hot key)
    are split by the skew-join rule."""
    n = max(200, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    }


def apply_session_settings(spark: SparkSession) -> None:
    """Apply the runtime SQL settings the library depends on to any session."""
    for k, v in _DEFAULTS.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Only
    a local-mode session without one gets a private temporary folder.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; configure a shared folder "
                "(HDFS/S3/…) reachable by every executor")
        root = tempfile.mkdtemp(prefix="pricelake-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def lake_root(spark: SparkSession) -> str:
    """Root of the lake (bronze/silver/gold folders).

    ``pricelake.lake.root`` wins; otherwise a folder under the shared
    checkpoint root.
    """
    root = spark.conf.get("pricelake.lake.root", None)
    if root:
        return root.rstrip("/")
    return f"{checkpoint_root(spark)}/pricelake-lake"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder in shared storage for one run of one job."""
    return f"{lake_root(spark)}/_scratch/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df, spark: SparkSession | None = None):
    """Reliable checkpoint into the shared checkpoint folder (survives
    executor loss, unlike a local checkpoint)."""
    from pyspark import StorageLevel
    spark = spark or df.sparkSession
    checkpoint_root(spark)
    # a reliable checkpoint runs its input twice (the job, then the write)
    # unless the input is persisted; persist only for the duration
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return held.checkpoint(eager=True)
    finally:
        held.unpersist()
