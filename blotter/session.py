"""Session helpers.

Library code never builds its own session; callers pass one in.  These
helpers exist for tests, the bench and command-line use, and for the one
place where the library needs shared storage: cutting lineage of iterative
jobs with ``DataFrame.checkpoint()`` under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at any scale: AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed ones.
_SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Suggested settings for a large cluster (about 100 TB of incidents on
# ~1000 executors).  Shuffles start wide and AQE coalesces them to about
# 256 MB per task; scan splits are 256 MB; skewed partitions above 1 GB
# (and 5x the median) are split.  Apply with ``apply_cluster_conf``.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    "spark.sql.session.timeZone": "UTC",
}


def apply_cluster_conf(spark: SparkSession, overrides: dict[str, str] | None = None) -> None:
    """Set :data:`CLUSTER_CONF` (plus ``overrides``) on a running session.
    The checkpoint folder is not set here: it comes from the cluster's
    ``spark.checkpoint.dir``."""
    for key, value in {**CLUSTER_CONF, **(overrides or {})}.items():
        spark.conf.set(key, value)


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "blotter") -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("BLOTTER_DRIVER_MEMORY", "16g"))
    )
    for key, value in _SCALE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory.

    ``spark.checkpoint.dir`` is read from the session and used as is.  Only
    a local-mode session without one (tests, the bench) gets a scratch
    folder; a cluster session without one is an error, because a
    machine-local folder would not survive the loss of that machine."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if not current:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current:
        return current
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(
            "spark.checkpoint.dir is not set; name a shared folder (HDFS/S3/...) for it on a cluster"
        )
    local = tempfile.mkdtemp(prefix="blotter-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never a
    local checkpoint: it would not survive executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers.

    Nothing to do where its parent folder is on ``PYTHONPATH`` (the usual
    way with ``--py-files`` or an installed package); otherwise the sources
    are zipped once per Spark context and sent with ``addPyFile``."""
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    on_path = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    sc = spark.sparkContext
    if root in on_path or getattr(sc, "_blotter_shipped", False):
        return
    target = os.path.join(tempfile.mkdtemp(prefix="blotter-py-"), "blotter_sources.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    sc.addPyFile(target)
    sc._blotter_shipped = True
