"""Spark session settings and the shared checkpoint location.

The settings here are the ones the plans rely on at scale:

* AQE re-plans joins and coalesces partitions from runtime statistics.
* AQE skew join splits a hot join key (one user or game holding a large share of
  all reviews) across many tasks instead of one.
* The broadcast thresholds are the size check behind every broadcast: a side is
  broadcast only when the optimizer's estimate (planning time) or the measured
  shuffle output (AQE, run time) is under the bound; above it the join stays a
  shuffled sort-merge join.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Upper bound for a broadcast side. Dimension tables (games, per-bucket offsets)
# fit far below it; a fact table never does.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024

SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": str(BROADCAST_LIMIT_BYTES),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(BROADCAST_LIMIT_BYTES),
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "recoflow",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the scale settings applied.

    ``master`` is left to ``spark-submit`` on a cluster; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_scale_conf(spark)
    return spark


# Cluster jobs: start shuffles wide enough for ~100 TB inputs (128 MB x 8192 ~ 1 TB
# per shuffle at the advisory size, more with larger partitions) and let AQE
# coalesce them to the measured size; spark-submit settings win.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.scheduler.mode": "FAIR",  # concurrent fits and segments share the slots
}


def build_cluster_session(app_name: str) -> SparkSession:
    """Session for ``spark-submit`` jobs: scale settings plus wide initial
    shuffles, unless the submitter already set them."""
    from pyspark import SparkConf

    active = SparkSession.getActiveSession()
    if active is not None:  # embedded use (tests, notebooks): keep its settings
        return active
    submitted = SparkConf()
    extra = {k: v for k, v in CLUSTER_CONF.items() if not submitted.contains(k)}
    return build_session(app_name=app_name, extra_conf=extra)


def apply_scale_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable scale settings to an existing session."""
    for key, value in SCALE_CONF.items():
        try:
            spark.conf.set(key, value)
        except Exception:  # static conf on an already running session
            pass


def default_parallelism(spark: SparkSession) -> int:
    """Task slots of the cluster (cores); a setting-based guess on Spark Connect."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        return int(spark.conf.get("spark.default.parallelism", None)
                   or spark.conf.get("spark.sql.shuffle.partitions", "200"))


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for cutting lineage.

    The cluster names it in ``spark.checkpoint.dir``; that setting always wins.
    Only a local-mode session (tests, a laptop) with no setting gets its own
    scratch folder, because a machine-local folder is not visible to other
    executors on a cluster.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the Spark Connect server")
        return configured
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        current = sc.getCheckpointDir()
        if not current:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a folder on shared storage"
        )
    path = tempfile.mkdtemp(prefix="recoflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
