"""Sinks: table writes with explicit modes, CSV, audit stamps, upsert.

Parquet has no MERGE: ``upsert`` computes the merged table as a DataFrame
(full outer join on the keys) and ``upsert_table`` writes it as a new snapshot
version next to the old one, so readers switch atomically to the newest
complete version (``read_latest_snapshot``).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewlens.session import scratch_path

MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append",
         "errorifexists": "errorifexists", "overwrite": "overwrite"}


def write_table(df: DataFrame, path: str, mode: str = "replace", fmt: str = "parquet",
                partition_by: Sequence[str] | None = None, sort_within: Sequence[str] | None = None,
                options: dict | None = None) -> None:
    """Write ``df``; ``mode`` is fail / replace / append (default replace: a rerun does not duplicate)."""
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    w = df.write.mode(MODES[mode]).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if options:
        w = w.options(**options)
    w.save(path)


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: what follows reads the files, and a lost
    executor doesn't repeat what came before."""
    path = scratch_path(df.sparkSession, label, uuid.uuid4().hex)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "replace") -> None:
    write_table(df, path, mode, fmt="csv", options={"header": "true"})


def read_csv(spark, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", "true").csv(path)


def stamp_audit(df: DataFrame, at: Column, created: bool = True) -> DataFrame:
    """Set ``updated_at`` (and ``created_at`` when ``created``) to ``at`` (inject a fixed time in tests)."""
    out = df.withColumn("updated_at", at)
    return out.withColumn("created_at", at) if created else out


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if any key occurs twice (a SQL upsert refuses to update one row twice in one statement)."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError(f"duplicate source keys on {list(keys)}")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str] | None = None,
           check_unique: bool = True) -> DataFrame:
    """INSERT ... ON CONFLICT (keys) DO UPDATE SET update_cols.

    Matched keys take ``update_cols`` from the source and every other column from
    the target; unmatched source rows are inserted; unmatched target rows are kept.
    """
    keys = list(keys)
    if check_unique:
        assert_unique(source, keys)
    others = [c for c in target.columns if c not in keys]
    update = set(others if update_cols is None else update_cols)
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in others], F.lit(True).alias("_t"))
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in others], F.lit(True).alias("_s"))
    j = t.join(s, keys, "full_outer")
    cols = []
    for c in others:
        if c in update:
            cols.append(F.when(F.col("_s"), F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c))
        else:
            cols.append(F.when(F.col("_t"), F.col(f"_t_{c}")).otherwise(F.col(f"_s_{c}")).alias(c))
    return j.select(*keys, *cols)
