"""EXISTS / NOT EXISTS / IN as equi joins.

The OR-of-array-membership EXISTS (id = admin OR id = any(users) OR id =
any(mentors)) would plan as a nested-loop join; it is rewritten to
explode -> distinct -> left equi join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _all_not_null(keys):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def exists_flag(df: DataFrame, other: DataFrame, keys: Sequence[str], name: str,
                other_keys: Sequence[str] | None = None) -> DataFrame:
    """Add boolean ``name``: some row of ``other`` matches on ``keys``."""
    keys = list(keys)
    other_keys = list(other_keys or keys)
    hits = (other.select(*[F.col(o).alias(k) for o, k in zip(other_keys, keys)])
            .filter(_all_not_null(keys))
            .distinct().withColumn(name, F.lit(True)))
    return df.join(hits, keys, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def group_member_ids(groups: DataFrame, scalar_cols: Sequence[str], array_cols: Sequence[str],
                     out: str = "user_id") -> DataFrame:
    """Distinct ids that appear in any scalar or array column of ``groups``."""
    elem_type = groups.schema[array_cols[0]].dataType.elementType if array_cols else None
    empty = F.array().cast(groups.schema[array_cols[0]].dataType) if array_cols else None
    parts = [F.array(*[F.col(c).cast(elem_type) if elem_type else F.col(c) for c in scalar_cols])]
    parts += [F.coalesce(F.col(c), empty) for c in array_cols]
    return (groups.select(F.explode(F.concat(*parts)).alias(out))
            .filter(F.col(out).isNotNull()).distinct())


def membership_flag(df: DataFrame, groups: DataFrame, key: str, scalar_cols: Sequence[str],
                    array_cols: Sequence[str], name: str) -> DataFrame:
    ids = group_member_ids(groups, scalar_cols, array_cols, out=key)
    return exists_flag(df, ids, [key], name)


def exclude(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """NOT EXISTS: drop rows of ``df`` whose keys appear in ``other``."""
    return df.join(other.select(*keys).distinct(), list(keys), "left_anti")
