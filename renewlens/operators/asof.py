"""As-of join: the last right row at or before each left row's time, per key.

Instead of meeting every left row with every right row of its key, both sides are united in time order and the
right side's values are carried forward: inside a segment ``(key, segment)`` by a window, from earlier segments by a
table of one row per (key, segment), the last right row of each.  A key with a third of all rows spreads over
its segments; no row count is a product of both sides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, values: Sequence[str],
              tie: Sequence[str] = (), segment=None) -> DataFrame:
    """``left`` with the columns ``values`` of the right row with the same ``key`` and the greatest ``right_time`` that
    is not after ``left_time``; of several such rows the one with the greatest ``tie`` columns.

    Left rows without such a row, with a null key or a null time keep null values.  Right rows with a null key or
    time match nothing.  Repeated left rows stay.  ``segment`` maps a time column to a coarser one that never falls
    as time rises (default: the month).
    """
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    seg = segment or (lambda c: F.trunc(c, "month"))
    payload = F.struct(*(F.col(v) for v in values))
    kind = right.select(payload.alias("v")).schema["v"].dataType
    order = F.struct(F.col(right_time).alias("_t"), *(F.col(c).alias(f"_tie{i}") for i, c in enumerate(tie)))
    okind = right.select(order.alias("o")).schema["o"].dataType
    rows = F.struct(*(F.col(f"`{c}`") for c in left.columns))
    lefts = left.select(F.col(key).alias("_key"), F.col(left_time).alias("_time"), F.lit(1).alias("_side"), rows.alias("_left"),
                        F.lit(None).cast(okind).alias("_order"), F.lit(None).cast(kind).alias("_value"))
    rights = (right.filter(F.col(key).isNotNull() & F.col(right_time).isNotNull())
              .select(F.col(key).alias("_key"), F.col(right_time).cast(left.schema[left_time].dataType).alias("_time"), F.lit(0).alias("_side"),
                      F.lit(None).cast(left.select(rows.alias("l")).schema["l"].dataType).alias("_left"), order.alias("_order"), payload.alias("_value")))
    both = lefts.unionByName(rights).withColumn("_seg", seg(F.col("_time")))

    inside = Window.partitionBy("_key", "_seg").orderBy("_time", "_side", "_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = both.withColumn("_in", F.last("_value", ignorenulls=True).over(inside)).filter("_side = 1")

    # one row per (key, segment), with or without a right row
    ends = both.filter(F.col("_key").isNotNull() & F.col("_time").isNotNull()).groupBy("_key", "_seg").agg(
        F.max(F.when(F.col("_side") == 0, F.struct("_order", "_value"))).alias("_last"))
    before = Window.partitionBy("_key").orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    edges = ends.select("_key", "_seg", F.last("_last._value", ignorenulls=True).over(before).alias("_edge"))

    found = F.coalesce("_in", "_edge")
    known = F.col("_key").isNotNull() & F.col("_time").isNotNull()
    return (carried.join(edges, ["_key", "_seg"], "left").withColumn("_found", F.when(known, found))
            .select("_left.*", *(F.col("_found")[v].alias(v) for v in values)))
