"""Scans.

``scan`` is the one entry point for relational and document sources: filters and
projections are declared on the DataFrame so Catalyst pushes them into the
parquet reader (``PushedFilters`` / ``ReadSchema``) or the JDBC query.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def scan(spark: SparkSession, path: str, schema=None, where: Column | str | None = None,
         columns: list[str] | None = None, limit: int | None = None, fmt: str = "parquet",
         options: dict | None = None) -> DataFrame:
    """Read a table; filter, project and limit lazily so they reach the scan."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if options:
        reader = reader.options(**options)
    df = reader.load(path)
    if where is not None:
        df = df.filter(where)
    if columns is not None:
        df = df.select(*columns)
    if limit is not None:
        df = df.limit(limit)
    return df


def scan_jdbc(spark: SparkSession, url: str, query: str, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, num_partitions: int = 64,
              fetchsize: int = 10_000, properties: dict | None = None) -> DataFrame:
    """Relational source through JDBC, split into parallel range reads when a
    numeric partition column is given."""
    reader = (spark.read.format("jdbc").option("url", url).option("fetchsize", fetchsize))
    if partition_column is not None:
        reader = (reader.option("dbtable", f"({query}) AS src")
                  .option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", num_partitions))
    else:
        reader = reader.option("query", query)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def scan_between(df: DataFrame, date_col: str, lo=None, hi=None, where: Column | None = None) -> DataFrame:
    """Rows with ``lo <= date_col <= hi`` (either end optional), ANDed with ``where``.

    Unlike a dict-merged document filter, an extra condition on the same column is
    kept and combined, never overwritten.
    """
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(date_col) >= F.lit(lo))
    if hi is not None:
        cond = cond & (F.col(date_col) <= F.lit(hi))
    if where is not None:
        cond = cond & where
    return df.filter(cond)


class Tables:
    """Lazy handles on the driver parquet tables of one scale-factor folder.

    A table's DataFrame (file listing + footer schema) is created once; it stays lazy, so every
    query still plans its own pruned scan.  ``saved`` names what was written for these tables (models, training rows).
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.saved: dict[str, str] = {}
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._read[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            return self.table(name)
        raise AttributeError(name)

    @cached_property
    def adapters(self):
        from renewlens.sources.adapters import Adapters

        return Adapters(self)
