"""Spark session settings for the report jobs."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# settings the jobs rely on: adaptive execution (partition coalescing, skew
# splitting, runtime join re-planning) and no web UI.
# Static broadcast planning is off: its size comes from compressed file sizes,
# which do not bound the in-memory size. Broadcasts then happen only where an
# operator counted the side (operators.relational.small_side) or where adaptive
# execution measured a finished shuffle below the adaptive threshold.
RECOMMENDED_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # target ~128 MB per post-shuffle partition; on a cluster set
    # spark.sql.shuffle.partitions high (input bytes / 128 MB) and let AQE
    # coalesce the small stages down
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # let AQE coalesce the partitions of persisted (size-checked) small sides
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # a dimension too large to broadcast still cuts the fact: Spark builds a Bloom
    # filter of its join keys and tests them right above the fact's scan, before the
    # shuffle; by default only for dimensions of 10 MB at most
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "100GB",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1GB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "forecheck",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    It is the one named by ``spark.checkpoint.dir``, else the one set on the
    Spark context. Where neither is set, a local master gets a fresh scratch
    folder (tests); on a cluster that is an error, because a folder made here
    would exist on the driver's machine only.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all "
                             "executors share")
        path = tempfile.mkdtemp(prefix="forecheck-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def shared_subdir(spark: SparkSession, *parts: str) -> str:
    return "/".join([ensure_checkpoint_dir(spark).rstrip("/"), *parts])
