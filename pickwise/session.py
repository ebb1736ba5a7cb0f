"""Session helpers: a local session for tests and the bench, and the shared
checkpoint folder that lineage cuts are written to."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "pickwise", driver_memory: str = "16g") -> SparkSession:
    """A ``local[cores]`` session configured like the cluster jobs expect:
    AQE on (partition coalescing + skew-join splitting), UI off, UTC."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        # Remove checkpoint files once nothing refers to them any more.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``checkpoint()`` has a target.

    The cluster names its shared folder in ``spark.checkpoint.dir``; that is
    used as is. Only a local session (tests, bench) without the setting gets a
    fresh folder of its own; on a cluster a missing setting is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master == "local" or sc.master.startswith("local["):      # not local-cluster
        folder = tempfile.mkdtemp(prefix="pickwise-ckpt-")
        sc.setCheckpointDir(folder)
        return folder
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/...) "
        "so that lineage cuts survive executor loss")
