"""Banding expressions (``when`` chains; Bucketizer is left-closed only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def band_below(x, edges_labels, else_label, null_label=None) -> Column:
    """First label whose upper edge is strictly greater than x (left-closed bins)."""
    col = F.col(x) if isinstance(x, str) else x
    expr = F.when(col.isNull(), F.lit(null_label))
    for edge, label in edges_labels:
        expr = expr.when(col < edge, label)
    return expr.otherwise(else_label)


def right_closed_bins(x, edges, labels) -> Column:
    """Bins (e0, e1], (e1, e2], ...; values outside (e0, e_last] are null."""
    col = F.col(x) if isinstance(x, str) else x
    expr = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = (col > lo) & (col <= hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr
