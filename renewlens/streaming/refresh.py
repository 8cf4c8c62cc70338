"""Incremental refresh of the location metric snapshot from a stream of location files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from renewlens.sources.sinks import upsert
from renewlens.sources.snapshots import read_latest_snapshot, version, write_snapshot


def refresh_location_metrics(spark: SparkSession, source_dir: str, source_schema, snapshot_path: str,
                             checkpoint: str, metrics_for: Callable[[DataFrame], DataFrame], metric_schema,
                             available_now: bool = True) -> StreamingQuery:
    """Start a file stream over ``source_dir`` (parquet location documents).

    For every micro-batch: the touched member ids (distinct, from the batch) are
    passed to ``metrics_for(member_ids)``, which must return fresh metric rows for
    those members computed from the full history; they are upserted on
    ``user_id`` into the newest snapshot and written as a new version; a repeated
    batch upserts the same rows again.
    ``checkpoint`` must live in the shared checkpoint folder so a restarted driver
    resumes exactly where the last committed batch ended.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        touched = batch.select(F.col("user_id").cast("string").alias("user_id")).distinct()
        fresh = metrics_for(touched)
        current = read_latest_snapshot(spark, snapshot_path, metric_schema)
        merged = upsert(current, fresh.select(*metric_schema.fieldNames()), ["user_id"])
        write_snapshot(merged, snapshot_path, version(tie=f"{batch_id:012d}"))

    reader = spark.readStream.schema(source_schema).parquet(source_dir)
    writer = reader.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
