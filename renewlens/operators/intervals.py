"""Unions of date intervals per key (both ends included).

Intervals of a key are collapsed to the latest end per start day, then run through in order of start with the
greatest end so far: inside a segment (key, month of the start) by a window, from earlier segments by a table of one
row per (key, segment).  A day counts once however many intervals hold it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _covered(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """keys, ``_start``, ``_end``, ``_seg`` and ``_reach``: the greatest end of the intervals that start earlier."""
    keys = list(keys)
    known = F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) <= F.col(end))
    days = (df.filter(known).groupBy(*keys, F.to_date(start).alias("_start")).agg(F.max(F.to_date(end)).alias("_end"))
            .withColumn("_seg", F.trunc("_start", "month")))
    inside = Window.partitionBy(*keys, "_seg").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    tops = days.groupBy(*keys, "_seg").agg(F.max("_end").alias("_top"))
    before = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.withColumn("_carried", F.max("_top").over(before)).drop("_top")
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys] + [F.col("d._seg") == F.col("t._seg")]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    both = days.withColumn("_in", F.max("_end").over(inside)).alias("d").join(tops.alias("t"), cond)
    return both.select(*(F.col(f"d.{k}").alias(k) for k in keys), "_start", "_end", F.col("d._seg").alias("_seg"),
                       F.greatest("_in", "_carried").alias("_reach"))


def covered_days(df: DataFrame, keys: Sequence[str], start: str, end: str, out: str = "days") -> DataFrame:
    """keys, ``out``: on how many days at least one interval lies, per key.

    Intervals without a start or end, or that end before they start, hold no day; a key with only such ones has no row.
    Null keys form a key of their own.
    """
    c = _covered(df, keys, start, end)
    fresh = F.greatest(F.datediff("_end", F.greatest(F.date_sub("_start", 1), "_reach")), F.lit(0))
    return c.groupBy(*keys).agg(F.sum(fresh).cast("int").alias(out))


def merged_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """keys, ``start``, ``end``: the intervals' union as maximal stretches of days (neighbouring days join).

    A stretch is numbered by the running count of starts that no earlier interval reaches, kept by segments as well.
    """
    keys = list(keys)
    c = _covered(df, keys, start, end).withColumn("_new", (F.col("_reach").isNull() | (F.col("_start") > F.date_add("_reach", 1))).cast("int"))
    inside = Window.partitionBy(*keys, "_seg").orderBy("_start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = c.groupBy(*keys, "_seg").agg(F.sum("_new").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_seg", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    cond = F.col("c._seg") == F.col("o._seg")
    for k in keys:
        cond = cond & F.col(f"c.{k}").eqNullSafe(F.col(f"o.{k}"))
    numbered = (c.withColumn("_n", F.sum("_new").over(inside)).alias("c").join(offsets.alias("o"), cond)
                .select(*(F.col(f"c.{k}").alias(k) for k in keys), "_start", "_end", (F.col("_n") + F.col("_off")).alias("_island")))
    return (numbered.groupBy(*keys, "_island").agg(F.min("_start").alias(start), F.max("_end").alias(end)).drop("_island"))
