"""Mergeable sketches kept per run: quantiles (KLL) for drift, distinct counts (HLL) for any range of months.

A sketch of a run is made in one scan of that run's rows and stored; reports over any runs merge the stored sketches
and never read rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size parameter of the quantile sketches.
K = 800
#: Ranks are read off so many quantiles of a sketch: Spark takes only constants for the value whose rank is asked for.
GRID = 1000


def share_error(k: int = K) -> float:
    """Bound (99 %) of the error of a share between two cut points, by the sketch's authors, and that of the grid."""
    return 2.446 / k**0.9433 + 2 / GRID


def feature_sketches(df: DataFrame, run: str, features: Sequence[str], k: int = K) -> DataFrame:
    """run, feature, n, sketch: one row per (run, feature), from one scan and one shuffle of sketches."""
    wide = df.groupBy(F.col(run).alias("run")).agg(
        *(F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(f"s_{c}") for c in features), *(F.count(c).alias(f"n_{c}") for c in features))
    pairs = F.array(*(F.struct(F.lit(c).alias("feature"), F.col(f"n_{c}").alias("n"), F.col(f"s_{c}").alias("sketch")) for c in features))
    return wide.select("run", F.explode(pairs).alias("f")).select("run", "f.*").filter("n > 0")


def merged_sketches(sketches: DataFrame, side) -> DataFrame:
    """side, feature, n, sketch over the stored rows with the value ``side`` (a column)."""
    return sketches.groupBy(side.alias("side"), "feature").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_drift(sketches: DataFrame, is_baseline, bins: int = 10, eps: float = 1e-4) -> DataFrame:
    """feature, psi, cuts, base_shares, cur_shares, baseline_rows, current_rows by merged sketches of the stored runs.

    Bins are cut at the baseline sketch's quantiles; equal cuts are one.  Shares below ``eps`` are floored at
    ``eps``, bins without rows on both sides count for nothing.  Features without rows on either side have no row.
    """
    both = merged_sketches(sketches, is_baseline)
    base = both.filter("side").select("feature", F.col("n").alias("baseline_rows"), F.col("sketch").alias("b"))
    cur = both.filter("not side").select("feature", F.col("n").alias("current_rows"), F.col("sketch").alias("c"))
    j = base.join(cur, "feature")
    at = F.array(*(F.lit(i / bins) for i in range(1, bins)))
    j = j.withColumn("cuts", F.array_distinct(F.kll_sketch_get_quantile_double("b", at)))

    ranks = F.array(*(F.lit(i / GRID) for i in range(1, GRID)))
    j = j.withColumns({"b": F.kll_sketch_get_quantile_double("b", ranks), "c": F.kll_sketch_get_quantile_double("c", ranks)})

    def shares(grid: str):
        below = F.transform("cuts", lambda c: F.size(F.filter(grid, lambda v: v <= c)) / F.lit(float(GRID)))
        ends = F.concat(F.array(F.lit(0.0)), below, F.array(F.lit(1.0)))
        return F.transform(F.sequence(F.lit(1), F.size("cuts") + 1), lambda i: F.element_at(ends, i + 1) - F.element_at(ends, i))

    j = j.withColumns({"base_shares": shares("b"), "cur_shares": shares("c")})
    floor = lambda x: F.greatest(x, F.lit(eps))
    part = F.zip_with("base_shares", "cur_shares", lambda b, c: F.when((b <= 0) & (c <= 0), 0.0).otherwise((floor(c) - floor(b)) * F.log(floor(c) / floor(b))))
    return j.select("feature", F.aggregate(part, F.lit(0.0), lambda a, x: a + x).alias("psi"), "cuts", "base_shares", "cur_shares", "baseline_rows", "current_rows")


def distinct_sketches(df: DataFrame, period, member: str, lg_k: int = 14) -> DataFrame:
    """period, sketch: one HLL sketch of the members per period; null members aren't counted."""
    return df.groupBy(period.alias("period")).agg(F.hll_sketch_agg(member, F.lit(lg_k)).alias("sketch"))


def distinct_over(sketches: DataFrame, months: int) -> DataFrame:
    """last_period, members: the estimated number of different members in each stretch of ``months`` months that ends with a
    stored one.  Every sketch goes to the stretches it belongs to; no member is read again."""
    ends = F.transform(F.sequence(F.lit(0), F.lit(months - 1)), lambda i: F.add_months("period", i))
    spread = sketches.select(F.explode(ends).alias("last_period"), "sketch").join(sketches.select(F.col("period").alias("last_period")), "last_period", "left_semi")
    return spread.groupBy("last_period").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("members"))
