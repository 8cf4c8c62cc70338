import uuid

from pyspark.sql import functions as F

from renewlens.config import DRIVER_CONFIG
from renewlens.plans.profile import location_metrics
from renewlens.session import scratch_path
from renewlens.sources.snapshots import read_latest_snapshot
from renewlens.sources.tables import Tables
from renewlens.streaming import refresh_location_metrics
from tests.conftest import SF001


def test_incremental_refresh_equals_batch(spark):
    t = Tables(spark, SF001)
    a = t.adapters
    base = scratch_path(spark, "stream", uuid.uuid4().hex)
    docs = a.member_locations
    # two arrivals of raw location documents
    docs.filter(F.col("point_id") % 2 == 0).write.parquet(f"{base}/in/part=0")
    schema = spark.read.parquet(f"{base}/in/part=0").schema

    def metrics_for(ids):
        hist = spark.read.schema(schema).parquet(f"{base}/in/*")
        owners = hist.withColumn("_u", F.col("user_id").cast("string")).join(
            ids.withColumnRenamed("user_id", "_u"), "_u", "left_semi").drop("_u")
        return location_metrics(a, DRIVER_CONFIG, owners)

    full = location_metrics(a, DRIVER_CONFIG)
    q = refresh_location_metrics(spark, f"{base}/in/*", schema, f"{base}/snap", f"{base}/ckpt", metrics_for,
                                 full.schema)
    q.awaitTermination()
    docs.filter(F.col("point_id") % 2 == 1).write.parquet(f"{base}/in/part=1")
    q = refresh_location_metrics(spark, f"{base}/in/*", schema, f"{base}/snap", f"{base}/ckpt", metrics_for,
                                 full.schema)
    q.awaitTermination()
    got = read_latest_snapshot(spark, f"{base}/snap", full.schema)
    key = lambda r: r.user_id
    assert sorted(got.collect(), key=key) == sorted(full.collect(), key=key)
