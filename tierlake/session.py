"""Session construction and the shared scratch folder.

Library code never builds its own session; it takes the caller's.  The
helpers here are for tests, the bench and command-line runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a local run needs; a cluster brings its own.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tierlake", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a local session for tests and the bench."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("TIERLAKE_DRIVER_MEMORY", "8g")))
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def cluster_conf(input_bytes: int, total_cores: int,
                 target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` of Parquet on ``total_cores``.

    * scans: split files at ``target_partition_bytes`` so each scan task
      reads about that much;
    * shuffles: start wide enough that no reducer holds more than the target
      (at least two waves of tasks), and let AQE coalesce small partitions up
      to the same advisory size - which is also roughly the size of each
      written file;
    * skew: a partition five times the median and above the target is split.

    At 100 TB with 1000 executors x 8 cores and 256 MB targets this gives
    ~400k shuffle partitions before coalescing.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
    }


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session.  Only when it is unset in local mode (a test or a
    laptop) do we pick a fresh local folder and register it as the checkpoint
    dir; on a cluster an unset folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tierlake-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A new, unique folder under the shared root (nothing is reused)."""
    return "/".join([shared_root(spark), "tierlake", *parts, uuid.uuid4().hex])
