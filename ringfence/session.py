"""Session construction and shared-storage helpers.

Everything that must survive executor loss (checkpoints, staged tables,
stream checkpoints) lives under the folder the cluster names in
``spark.checkpoint.dir``.  We read it from the session and only set our own
when it is unset (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "ringfence", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


MB = 1024 * 1024


def cluster_profile(input_bytes: int, total_cores: int, partition_mb: int = 256) -> dict:
    """Sizing for a large cluster, given the bytes a job reads and the cores it has.

    * scan splits of ``partition_mb`` (parquet row groups permitting);
    * initial shuffle partitions so each holds about ``partition_mb`` before AQE
      coalesces, and at least 3 waves of tasks;
    * AQE skew join splits any partition 5x the median and above 1 GiB;
    * broadcast joins only below 64 MiB (AQE re-checks the runtime size).
    """
    shuffle = max(3 * total_cores, input_bytes // (partition_mb * MB))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_mb * MB),
        "spark.sql.shuffle.partitions": str(int(shuffle)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_mb * MB),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * MB),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.sql.parquet.compression.codec": "snappy",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a private one only if unset.

    ``spark.checkpoint.dir`` cannot be changed on a running session, so a
    fallback folder (local tests only) is recorded under ``ringfence.checkpointDir``.
    """
    path = (spark.conf.get("spark.checkpoint.dir", None)
            or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
            or spark.conf.get("ringfence.checkpointDir", None))
    master = spark.sparkContext.master
    if not path and master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not path:
        # Local tests only: a cluster always names a shared folder.
        path = tempfile.mkdtemp(prefix="ringfence-ckpt-")
        spark.conf.set("ringfence.checkpointDir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared checkpoint folder (optionally unique per call)."""
    base = ensure_checkpoint_dir(spark)
    tail = list(parts)
    if unique:
        tail.append(uuid.uuid4().hex[:12])
    return os.path.join(base, "ringfence", *tail)


def fresh_path(spark: SparkSession, *parts: str) -> str:
    """A stable path under the shared folder whose previous contents (this
    job's own earlier output) are replaced: removed through the Hadoop
    FileSystem API so it works on any cluster file system."""
    path = shared_path(spark, *parts)
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(jpath):
        fs.delete(jpath, True)
    return path
