"""Session helpers.

Only ``build_session`` creates a session (tests, bench, local runs). Library
functions never change the caller's session except ``ensure_checkpoint_dir``,
which sets a checkpoint directory only when the cluster has not named one.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a production run keeps from the cluster; the local builder only
# pins what makes local runs deterministic and small.
_LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast limits (see cluster_settings): the static planner, which
    # estimates from compressed file sizes, only broadcasts tiny tables;
    # AQE broadcasts a side whose shuffle output is measured under 10 MB,
    # else the join stays a sort-merge join.
    "spark.sql.autoBroadcastJoinThreshold": "1048576",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10485760",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call-site capture for error messages costs several JVM round trips per
    # DataFrame call; plans of the profile build make thousands of calls.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str = "local[8]", app_name: str = "entiprof", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    merged = dict(_LOCAL_CONF)
    merged.setdefault("spark.driver.memory", os.environ.get("ENTIPROF_DRIVER_MEMORY", "8g"))
    merged.update(conf)
    for key, value in merged.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(
    input_bytes: int,
    executors: int,
    cores_per_executor: int,
    target_partition_bytes: int = 256 * 1024 * 1024,
) -> dict[str, str]:
    """Session settings for a profile build over ``input_bytes`` of parquet.

    The initial shuffle partition count is sized so that the widest exchange
    (roughly the input volume) lands near ``target_partition_bytes`` per
    partition, never below two waves of the cluster's task slots; AQE
    then coalesces small stages and splits skewed partitions (a partition is
    skewed above 5x the median and above the target size). File splits
    follow the same target so a scan task reads about one partition's worth.
    Broadcast limits: the static planner estimates from compressed file
    sizes, so it may only broadcast tiny tables (under 1 MB estimated, small
    even after a 10x decompression) and the large side of such a join is
    never shuffled; any other side is broadcast only when AQE has measured
    its shuffle output under 10 MB, otherwise the join stays a sort-merge
    join.
    """
    slots = max(1, executors * cores_per_executor)
    partitions = max(2 * slots, -(-input_bytes // target_partition_bytes))
    target = str(target_partition_bytes)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": target,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": target,
        "spark.sql.files.maxPartitionBytes": target,
        "spark.sql.autoBroadcastJoinThreshold": "1048576",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "10485760",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint directory.

    On a cluster the directory comes from ``spark.checkpoint.dir`` (a shared
    folder every executor can reach). Only when nothing is configured (local
    tests) a fresh scratch folder is created.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="entiprof-ckpt-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
