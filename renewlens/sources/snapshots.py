"""Timestamped snapshots: a dataset partitioned by ``run_ts``; consumers read the newest
version whose write was completed.

A version counts once its name is in the small table ``_versions`` next to the partitions,
which is appended to after the data are committed.  Names are UTC times, so versions of
all writers sort together.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def version(at: datetime | None = None, tie: str = "") -> str:
    """YYYYMMDD_HHMMSS of ``at`` (now, if not given), with ``tie`` to tell versions of one second apart."""
    name = (at or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")
    return f"{name}_{tie}" if tie else name


def write_snapshot(df: DataFrame, path: str, run_ts: str) -> None:
    """Write one version (re-running the same run_ts replaces only that version) and publish it."""
    (df.withColumn("run_ts", F.lit(run_ts)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run_ts").parquet(path))
    done = df.sparkSession.createDataFrame([(run_ts,)], "run_ts string").coalesce(1)
    done.write.mode("append").parquet(f"{path}/_versions")


def read_latest_snapshot(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Rows of the newest completed version.

    Only where ``path`` doesn't exist, an empty frame of ``schema`` is returned (and without a schema
    the error raised); a folder that can't be read, or without a completed version, raises.
    """
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if schema is None or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    latest = spark.read.schema("run_ts string").parquet(f"{path}/_versions").agg(F.max("run_ts")).scalar()
    out = df.filter(F.col("run_ts").cast("string") == latest).drop("run_ts")
    return out.select(*schema.fieldNames()) if schema is not None else out


__all__ = ["read_latest_snapshot", "version", "write_snapshot"]
