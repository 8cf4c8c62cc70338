"""Tables by partition: copy-on-write upserts, and tables laid out by date and bucketed by member.

A copy-on-write table has its files under ``data/v=<version>/<column>=<value>`` and, per version, a manifest that
says which version's folder holds each partition.  An upsert joins and writes only the partitions that its source
touches; the others stay where they are and are carried over by name.  A version counts once it is in ``_versions``, so
readers see a whole version or none of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from renewlens.sources.sinks import upsert


def _manifest(spark: SparkSession, path: str) -> dict[str | None, str]:
    """Partition -> version of the newest completed version.  As many rows as the table has partitions."""
    try:
        latest = spark.read.schema("run_ts string").parquet(f"{path}/_versions").agg(F.max("run_ts")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    rows = spark.read.schema("part string, v string").parquet(f"{path}/_manifest/{latest}").collect()
    return {r.part: r.v for r in rows}


def _publish(spark: SparkSession, path: str, version: str, manifest: dict[str | None, str]) -> None:
    rows = spark.createDataFrame([(p, v) for p, v in manifest.items()], "part string, v string").coalesce(1)
    rows.write.mode("overwrite").parquet(f"{path}/_manifest/{version}")
    spark.createDataFrame([(version,)], "run_ts string").coalesce(1).write.mode("append").parquet(f"{path}/_versions")


def _parts(df: DataFrame, column: str) -> list[str | None]:
    return [r[0] for r in df.select(F.col(column).cast("string")).distinct().collect()]


def _read(spark: SparkSession, path: str, schema: StructType, column: str, wanted: dict[str | None, str]) -> DataFrame:
    """The partitions ``wanted``, by a predicate on partition columns alone."""
    if not wanted:
        return spark.createDataFrame([], schema)
    fields = [f for f in schema.fields if f.name != column]
    full = StructType([*fields, StructField("v", StringType()), schema[column]])
    by_version: dict[str, list] = {}
    for part, v in wanted.items():
        by_version.setdefault(v, []).append(part)
    keep: Column = F.lit(False)
    for v, parts in sorted(by_version.items()):
        value = F.col(column)
        there = [p for p in parts if p is not None]
        hit = value.isin(*(F.lit(p).cast(schema[column].dataType) for p in there)) if there else F.lit(False)
        if None in parts:
            hit = hit | value.isNull()
        keep = keep | ((F.col("v") == v) & hit)
    return spark.read.schema(full).parquet(f"{path}/data").filter(keep).select(*schema.fieldNames())


def read_table(spark: SparkSession, path: str, schema: StructType, partition_by: str) -> DataFrame:
    """The newest completed version."""
    return _read(spark, path, schema, partition_by, _manifest(spark, path))


def upsert_partitions(source: DataFrame, path: str, keys: Sequence[str], partition_by: str, version: str,
                      update_cols: Sequence[str] | None = None) -> list[str | None]:
    """Upsert ``source`` as a new version of the table at ``path`` (created if there is none); the partitions rewritten.

    ``partition_by`` must be one of ``keys``: a row can't move to another partition.  Keys may occur once in the
    source; a null in a key matches nothing, as in SQL, so such rows are added.  An empty source publishes a version equal to the last.  The driver gets one row per partition.
    """
    if partition_by not in keys:
        raise ValueError("the partition column is part of the key")
    spark, manifest = source.sparkSession, _manifest(source.sparkSession, path)
    touched = _parts(source, partition_by)
    old = {p: manifest[p] for p in touched if p in manifest}
    target = _read(spark, path, source.schema, partition_by, old)
    merged = upsert(target, source, keys, update_cols).select(*source.columns) if old else source
    if touched:
        merged.write.mode("overwrite").partitionBy(partition_by).parquet(f"{path}/data/v={version}")
    _publish(spark, path, version, manifest | {p: version for p in touched})
    return touched


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, by: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to ``path`` as ``table``, bucketed and sorted by ``by`` (the member) within partitions ``partition_by`` (a date).

    Joins and aggregates on ``by`` of tables with as many buckets need no exchange; filters on the partition
    column reach the file listing.  Files hold a bucket of one write task: rows are dealt by bucket first.
    """
    dealt = df.repartition(buckets, *by) if not partition_by else df.repartition(*partition_by, *by)
    w = dealt.write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by).option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(table)
    return df.sparkSession.table(table)
