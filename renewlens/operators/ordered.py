"""Neighbour values in an ordered group, without one task per hot group.

``lead``/``lag`` over ``partition by key`` sends every row of a key to one task.
Here rows are split into segments ``(key, segment)`` where ``segment`` is a
coarse monotone function of the order column (a date by default): the neighbour
is looked up inside the segment with a window, and at segment edges from a small
per-segment table (first/last row of each segment, one row per segment), which is
ranked per key.  A member with a third of all rows spreads over its distinct
dates; the per-segment table has at most one row per (member, date).

Rows with a null key get a null neighbour (SQL would otherwise group all null keys
into one shared partition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def neighbour_in_order(df: DataFrame, key: str, order_col: str, tie_col: str, value_col: str,
                       out_col: str, direction: str = "next", segment: Column | None = None) -> DataFrame:
    """Add ``out_col`` = value of the next (``direction='next'``) or previous row per ``key``
    in ``(order_col, tie_col)`` order."""
    if direction not in ("next", "prev"):
        raise ValueError(direction)
    seg = segment if segment is not None else F.col(order_col)
    cols = df.columns
    d = df.withColumn("_seg", seg)

    # Null keys stay in the same pass: like any hot key they spread over their
    # segments, and their neighbour is nulled at the end (no second branch that
    # would recompute the input).
    w = Window.partitionBy(key, "_seg").orderBy(order_col, tie_col)
    shift = F.lead if direction == "next" else F.lag
    inner = (d.withColumn("_in", shift(F.col(value_col)).over(w))
             .withColumn("_edge", shift(F.lit(1)).over(w).isNull()))

    edge_struct = F.struct(F.col(order_col).alias("o"), F.col(tie_col).alias("t"), F.col(value_col).alias("v"))
    pick = F.min if direction == "next" else F.max           # first row of the next / last row of the previous segment
    heads = d.filter(F.col(key).isNotNull()).groupBy(key, "_seg").agg(pick(edge_struct).alias("_h"))
    wseg = Window.partitionBy(key).orderBy("_seg")
    seg_nb = heads.select(key, "_seg", shift(F.col("_h.v")).over(wseg).alias("_seg_nb"))

    nb = F.when(F.col(key).isNull(), F.lit(None)).when(F.col("_edge"), F.col("_seg_nb")).otherwise(F.col("_in"))
    return (inner.join(seg_nb, [key, "_seg"], "left")
            .withColumn(out_col, nb.cast(df.schema[value_col].dataType))
            .select(*cols, out_col))


def running_in_order(df: DataFrame, key: str, order: list[str], rank_col: str | None = None,
                     sum_col: str | None = None, sum_out: str | None = None, rank_fn: str = "row_number",
                     segment: Column | None = None) -> DataFrame:
    """Per-``key`` rank and running sum in ``order`` (ascending, nulls last) without sending a
    key's rows to one task.

    Inside a segment ``(key, segment)`` the window gives a local rank/sum; a per-segment
    table (row count and total per segment, one row per (key, segment)) gives the offset
    of all earlier segments.  ``segment`` must be a monotone function of the first order
    column (default: that column), so ties never straddle two segments.  ``rank_fn`` is
    ``row_number`` or ``rank``; the running sum includes peers (RANGE frame), like SQL.
    """
    seg = segment if segment is not None else F.col(order[0])
    d = df.withColumn("_seg", seg)
    ordering = [F.col(c).asc_nulls_last() for c in order]
    w = Window.partitionBy(key, "_seg").orderBy(*ordering)
    out = d
    if rank_col:
        fn = F.row_number() if rank_fn == "row_number" else F.rank()
        out = out.withColumn("_r_in", fn.over(w))
    if sum_col:
        out = out.withColumn("_s_in", F.sum(sum_col).over(w.rangeBetween(Window.unboundedPreceding,
                                                                          Window.currentRow)))
    totals = d.groupBy(key, "_seg").agg(F.count(F.lit(1)).alias("_n"),
                                        *( [F.sum(sum_col).alias("_t")] if sum_col else []))
    wseg = Window.partitionBy(key).orderBy(F.col("_seg").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(key, "_seg", F.coalesce(F.sum("_n").over(wseg), F.lit(0)).alias("_n_off"),
                            *([F.coalesce(F.sum("_t").over(wseg), F.lit(0)).alias("_t_off")] if sum_col else []))
    # null keys form ordinary groups here (SQL semantics); the null-safe join keeps them matched
    j = out.join(offsets, (out[key].eqNullSafe(offsets[key])) & (out["_seg"].eqNullSafe(offsets["_seg"])), "left")
    j = j.drop(offsets[key]).drop(offsets["_seg"])
    cols = list(df.columns)
    if rank_col:
        j = j.withColumn(rank_col, (F.col("_r_in") + F.col("_n_off")).cast("int"))
        cols.append(rank_col)
    if sum_col:
        j = j.withColumn(sum_out or f"{sum_col}_running", F.col("_s_in") + F.col("_t_off"))
        cols.append(sum_out or f"{sum_col}_running")
    return j.select(*cols)
