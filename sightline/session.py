"""Session settings shared by every job.

The jobs only rely on settings a Spark user sets per session: UTC as the
session time zone (all day / month / week keys are UTC), adaptive query
execution (runtime coalescing and skew-join splitting), and dynamic partition
overwrite for the period tables.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the results depend on: forced on any session a job receives.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}
# Set where the session names no value of its own. Tasks keep most rows they read in
# hash tables, ten to thirty times what compressed shuffles and files hold: tasks of
# Spark's 64 MB behind a shuffle and 128 MB of a file would spill.
UNLESS_SET = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
              "spark.sql.files.maxPartitionBytes": "16m"}
# Performance settings: applied when this package builds the session; a
# cluster's own values are left alone.
SESSION_DEFAULTS = {
    **REQUIRED,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the results depend on (idempotent)."""
    for key, value in REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, value in UNLESS_SET.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "sightline", extra: dict | None = None) -> SparkSession:
    """Session for tests / bench / local runs. On a cluster, pass master=None."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # checkpoint files of intermediates are removed once unreferenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("SIGHTLINE_DRIVER_MEMORY", "16g"),
        **SESSION_DEFAULTS,
    }
    if shuffle_partitions:
        # small local runs: keep one task per core after each shuffle instead
        # of letting AQE merge the (tiny) partitions into one task
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        conf["spark.sql.adaptive.coalescePartitions.enabled"] = "false"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return configure(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared file
    system path named by the cluster). Only when nothing is set (tests, local
    runs) a fresh scratch folder is created for this session.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object "
                               "store); a machine-local folder does not survive executors")
        configured = tempfile.mkdtemp(prefix="sightline-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df):
    """Write an intermediate used by several branches once (reliable
    checkpoint in the shared checkpoint folder) and read it from there: no
    branch recomputes its inputs, and a lost executor does not either."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cluster_conf(input_bytes: int, total_cores: int, target_partition_mb: int = 256) -> dict:
    """Settings sized for a large run (e.g. 100 TB on 1000 executors x 8 cores).

    * shuffle partitions ~ input / 256 MB (at least 3 waves of the cores), so
      a post-shuffle task holds a few hundred MB and sorts / aggregates spill
      rarely; AQE then coalesces small ones and splits skewed ones;
    * file splits of 256 MB for the scans;
    * AQE skew join on for partitions > 5x the median and > 512 MB (the
      salted co-occurrence join is covered by salting already);
    * the broadcast threshold stays at a size a task can hold (64 MB); the
      jobs themselves broadcast only tables with a proven bound.
    """
    mb = 1024 * 1024
    parts = max(3 * total_cores, int(input_bytes // (target_partition_mb * mb)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
