"""Session helpers.

Library code never creates or reconfigures a session; these helpers are for
tests, the bench and command-line use.  The checkpoint folder is read from the
session (``spark.checkpoint.dir``, the shared folder a cluster names) and only
set here when it is unset, as in local tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "renewlens") -> SparkSession:
    folder = tempfile.mkdtemp(prefix="renewlens-warehouse-")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", f"file://{folder}")
        .config("spark.ui.showConsoleProgress", "false")
        # batch runs: skip per-call Python stack capture used only for error context
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("RENEWLENS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only if the session has none."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns checkpointing; read its setting
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return path.rstrip("/")
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if path:
        if not current:
            sc.setCheckpointDir(path)
        return path.rstrip("/")
    if current:
        return current.rstrip("/")
    # Unset: only a local run, whose driver is its one executor, may use a folder of its own.
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="renewlens-")
    sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (never a machine-local temp dir)."""
    return "/".join([checkpoint_dir(spark), "renewlens", *parts])


def cluster_conf(input_bytes: int, executor_cores: int) -> dict[str, str]:
    """Recommended settings for a large cluster run (pass to the session builder / spark-submit).

    Shuffle partitions are sized for ~256 MB per partition of the largest input before AQE
    coalesces them; skew-join splitting and runtime broadcast decisions stay on; file
    splits of 256 MB keep scan tasks large enough to amortise scheduling.
    """
    target = 256 * 1024 * 1024
    shuffle = max(executor_cores * 3, input_bytes // target)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.shuffle.partitions": str(int(shuffle)),
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.session.timeZone": "UTC",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
