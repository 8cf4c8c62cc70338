"""Top-1 / top-k per group.

``top1_by`` is an aggregate (``max``/``min`` over an ordering struct), so Spark
combines map-side: a member holding a third of all rows is reduced inside every
map task before the shuffle and never lands whole in one task.

``top_k_by`` uses ``row_number() <= k``; Catalyst turns that into a partial
``WindowGroupLimit`` below the exchange, so each map task ships at most k rows per
group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def top1_by(df: DataFrame, keys: Sequence[str], order: Sequence, tie: Sequence = (),
            descending: bool = True, nulls_last: bool = True, payload: Sequence[str] | None = None,
            extra_aggs: Sequence[Column] = ()) -> DataFrame:
    """One row per ``keys``: the row first in ``order`` (+ ``tie``) order.

    All order and tie expressions share one direction.  Rows whose order value is
    null come last (``nulls_last``) or first.  Returns ``keys`` + ``payload``
    columns (default: all other columns) + ``extra_aggs`` computed in the same
    aggregation (e.g. a group total), so the input is read once.
    """
    keys = list(keys)
    payload = [c for c in (payload or df.columns) if c not in keys]
    fields = []
    for i, o in enumerate(order):
        o = _col(o)
        null_flag = o.isNull() if (nulls_last != descending) else o.isNotNull()
        fields += [null_flag.alias(f"_n{i}"), o.alias(f"_o{i}")]
    fields += [_col(t).alias(f"_t{i}") for i, t in enumerate(tie)]
    fields.append(F.struct(*[F.col(c) for c in payload]).alias("_p"))
    agg = F.max if descending else F.min
    extra = list(extra_aggs)
    out = df.groupBy(*keys).agg(agg(F.struct(*fields)).alias("_best"), *extra)
    extra_cols = [c for c in out.columns if c not in keys and c != "_best"]
    return out.select(*keys, *[F.col(f"_best._p.{c}").alias(c) for c in payload], *extra_cols)


def latest_by(df, keys, order, tie=(), payload=None) -> DataFrame:
    """``row_number() over (partition by keys order by order desc nulls last, tie desc) = 1``."""
    return top1_by(df, keys, order, tie, descending=True, nulls_last=True, payload=payload)


def earliest_by(df, keys, order, tie=(), payload=None) -> DataFrame:
    """``row_number() over (partition by keys order by order asc nulls last, tie asc) = 1``."""
    return top1_by(df, keys, order, tie, descending=False, nulls_last=True, payload=payload)


def top_k_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank_col: str = "rn") -> DataFrame:
    """Rows ranked 1..k per group by ``order`` (Column sort expressions, tie-break included)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def first_k_pivot(df: DataFrame, key: str, order: Sequence[Column], values: dict[str, str], k: int = 5,
                  names: Sequence[str] | None = None) -> DataFrame:
    """Rank rows per ``key`` and pivot ranks 1..k into columns.

    ``values`` maps an output suffix to a source column; output column for rank i is
    ``f"{names[i-1]}{suffix}"`` (names default to ``r1_``, ``r2_``, ...).
    """
    names = list(names or [f"r{i}_" for i in range(1, k + 1)])
    ranked = top_k_by(df, [key], order, k)
    aggs = []
    for i in range(1, k + 1):
        for suffix, src in values.items():
            aggs.append(F.max(F.when(F.col("rn") == i, F.col(src))).alias(f"{names[i - 1]}{suffix}"))
    return ranked.groupBy(key).agg(*aggs)
