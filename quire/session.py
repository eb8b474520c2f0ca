"""Session helpers.

Library operators never change session settings. These helpers are for
tests, the bench and local runs; on a cluster the session is built by the
caller and these functions only read from it.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and partition counts
# from runtime sizes and splits skewed join partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


# Suggested settings for a large cluster (not applied by the library): many
# initial shuffle partitions that AQE coalesces to ~256 MB each; 128 MB
# scan splits; small Arrow batches for binary-file conversion, where one
# row can be a whole PDF; the stream's state on the executors' disks.
CLUSTER_CONF = {
    **SCALE_CONF,
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "64",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "quire", extra_conf: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]")
               .appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in {**SCALE_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used as is. When it is
    unset, a session of one process (master ``local``), whose tasks all see the
    driver's folders, gets a fresh scratch folder; any other session has no
    folder that its executors share, and this raises.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="quire-ckpt-")
    spark.sparkContext.setCheckpointDir(path)   # found by getCheckpointDir() from now on
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder, for written tables that cut
    lineage or hold a job's intermediate state."""
    return os.path.join(ensure_checkpoint_dir(spark), name)
