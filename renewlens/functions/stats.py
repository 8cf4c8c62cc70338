"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_mean(col: str, in_scale: int = 10, out_scale: int = 12) -> Column:
    """Mean of a double column, independent of summation order.

    Values are summed as ``DECIMAL(20, in_scale)`` (exact), the sum is scaled to an
    integer and divided by the count with half-up rounding using exact integral
    division (``div``), and the result is returned as ``q / 10^out_scale`` (one IEEE
    division).  A plain double ``avg`` depends on the order partial sums are merged in,
    so it can change between runs with a different partitioning; this does not.  Null
    when there are no values.
    """
    c = f"`{col}`"
    n = f"count({c})"
    x = f"cast(sum(cast({c} AS DECIMAL(20,{in_scale}))) * {10 ** out_scale} AS DECIMAL(38,0))"
    q = f"((abs({x}) * 2 + {n}) div ({n} * 2))"
    return F.expr(f"CASE WHEN {n} > 0 THEN signum({x}) * CAST({q} AS DOUBLE) / "
                  f"CAST({10 ** out_scale} AS DOUBLE) END")
