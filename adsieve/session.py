"""SparkSession helpers: local test sessions and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this library relies on.
REQUIRED_CONF = {
    # hour buckets and archive paths are computed on wall-clock values
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # objects with repeated keys decode, the last value stands (the decoder)
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # archive partition values like hour=01 must stay strings on read
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "adsieve") -> SparkSession:
    """A local session for tests and the bench (UI off, no extra ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("ADSIEVE_DRIVER_MEMORY", "8g"))
        .config("spark.python.unix.domain.socket.enabled", "true")
        .config("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The cluster's ``spark.checkpoint.dir`` wins; a scratch folder is only set
    when nothing is configured (local tests).
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        sc = None
    if sc is not None and not configured:
        configured = sc.getCheckpointDir()
    if configured:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    master = spark.conf.get("spark.master", "") or (sc.master if sc is not None else "")
    if not master.startswith("local"):
        # a machine-local folder is not shared by the executors of a cluster
        raise ValueError("set spark.checkpoint.dir to a shared folder (the stage of the batch job lives there)")
    path = tempfile.mkdtemp(prefix="adsieve-ckpt-", dir="/tmp")
    if sc is not None:
        sc.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def apply_required_conf(spark: SparkSession) -> None:
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
