"""Session construction and shared scratch locations."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings used by tests, the bench and the pipeline CLI.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


# Starting points for a large cluster (~100 TB inputs, ~1000 executors).
# The shuffle partition count comes from the input's size (``size_shuffles``), the one
# rule for it; AQE coalesces to ~256 MB partitions; hot join partitions are split; lost executors are retried and, with decommissioning,
# their shuffle blocks migrate instead of being recomputed.
CLUSTER_CONF = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
}


def get_session(app_name: str = "strata", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None, cluster: bool = False) -> SparkSession:
    """Build (or reuse) a session. On a cluster pass ``master=None`` (spark-submit
    decides) and ``cluster=True`` for the large-cluster defaults; in tests pass
    ``local[N]``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int, target_bytes: int = 256 * 1024 * 1024,
                  expansion: float = 2.0, minimum: int = 200) -> int:
    """Initial shuffle partition count from the input size: shuffled bytes are
    estimated as ``expansion`` x the (compressed) input, cut into partitions of
    ``target_bytes``; AQE then coalesces what turns out smaller. Returns the
    count it set."""
    n = max(minimum, int(input_bytes * expansion // target_bytes) + 1)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    return n


def _is_local(spark: SparkSession) -> bool:
    """One JVM on one machine (``local-cluster`` is a cluster)."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Read from ``spark.checkpoint.dir``. Only a local session (tests) may fall
    back to a folder of its own; on a cluster an unset value is an error,
    because a machine-local folder is not visible to the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused location under the shared checkpoint folder.

    Scratch tables belong to the run that made them and may be read until its result is; the
    owner of the checkpoint folder removes ``strata-scratch`` between runs."""
    root = checkpoint_root(spark)
    return f"{root}/strata-scratch/{label}-{uuid.uuid4().hex}"
