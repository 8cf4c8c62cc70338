"""Left join whose null keys don't meet in one task.

A hot key is left to AQE, which splits its partition of a sort-merge join at run time.  Null
keys match nothing, yet a plain left join shuffles all of them to one partition; here they are
spread by a hash of the row instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join(big: DataFrame, small: DataFrame, key: str, spread_by: Sequence[str]) -> DataFrame:
    """``big.join(small, key, "left")``; rows of ``big`` with a null key are dealt by a hash of ``spread_by``."""
    b = big.withColumn("_spread", F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*spread_by), F.lit(1 << 30))).otherwise(F.lit(0)))
    s = small.withColumn("_spread", F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.lit(0)).cast("long"))
    return b.join(s, [key, "_spread"], "left").drop("_spread")
