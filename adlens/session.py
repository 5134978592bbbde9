"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes (its
# broadcast threshold is the size check for dimension joins), coalesces small
# shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "adlens", master: str | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Return a session with the library defaults applied.

    ``master`` is only set when given (a cluster launcher supplies its own).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    size_shuffles(spark)
    return spark


# Shuffle partitions per core on a cluster when the launcher sets none: a
# fact-sized shuffle then has many moderate partitions that spill gracefully,
# and AQE merges the small ones up to the advisory size after each map stage.
PARTITIONS_PER_CORE = 8
ADVISORY_PARTITION_BYTES = "256m"


def size_shuffles(spark: SparkSession) -> None:
    """Size shuffles for the cluster unless the launcher already did.

    Local sessions (tests, bench) keep what they were given.
    """
    sc = spark.sparkContext
    if sc.master.startswith("local") or sc.getConf().contains("spark.sql.shuffle.partitions"):
        return
    spark.conf.set("spark.sql.shuffle.partitions",
                   str(max(200, PARTITIONS_PER_CORE * sc.defaultParallelism)))
    if not sc.getConf().contains("spark.sql.adaptive.advisoryPartitionSizeInBytes"):
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", ADVISORY_PARTITION_BYTES)
        # coalesce towards the advisory size, not towards one partition per core
        spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; that setting is always
    honoured. Only a local-mode session without one (tests) gets a fresh
    scratch folder of its own.
    """
    sc = spark.sparkContext
    # spark.checkpoint.dir is a launch-time setting (it cannot be changed at
    # run time); a folder chosen later lives on the context instead
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="adlens-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table under the shared checkpoint folder.

    Unique per call, so two warehouses in one session (e.g. over two data
    folders) never write to the same place.
    """
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "adlens-tables", f"{name}-{uuid.uuid4().hex}")
