"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "priceframe", file_split_bytes: str = "256m",
                  target_partition_bytes: str = "256m") -> SparkSession:
    """A session tuned for this library; on a cluster the master comes from spark-submit.

    AQE is on so shuffle widths coalesce at runtime toward
    ``target_partition_bytes`` and small join sides are converted to broadcast
    only after their real size is known; skewed shuffle partitions are split.
    Scans cut files into ``file_split_bytes`` splits.  ``shuffle_partitions`` is
    the initial shuffle width: on a cluster size it to about (largest shuffle
    in bytes) / ``target_partition_bytes`` and let AQE coalesce.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Texts are long: small batches bound what a Python worker holds.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        "spark.sql.files.maxPartitionBytes": file_split_bytes,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": target_partition_bytes,
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when the setting is absent (local tests) is a scratch folder created
    and registered; on a cluster the configured shared path is always used.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="priceframe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables (tracked per application)."""
    path = os.path.join(ensure_checkpoint_dir(spark), name)
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete this application's intermediates from the shared folder; returns how many.

    Call it when the session's results are written: DataFrames still reading an
    intermediate (the fact snapshot included) must not be used afterwards.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    n = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if fs.exists(hp):
            fs.delete(hp, True)
            n += 1
    from .plans import bindings
    bindings.forget_snapshots(spark)
    return n
