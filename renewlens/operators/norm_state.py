"""Personal norms kept up to date from what newly arrived.

The norm of a week is a weighted mean of the weeks before it, so its weighted sum is linear in every week's amount.  A
member's state is one row: first and last week and the weighted sum as of the last week.  Newly arrived
amounts, of whatever weeks, move the state forward and give the norms that change: those from the earliest of
these weeks on.  Old activity isn't read again, nor are norms of other members or earlier weeks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewlens.operators.weekly import ewma_norm

STATE = "user_id long, first_week date, last_week date, weighted double"


def _weeks(later: str | Column, earlier: str | Column) -> Column:
    return F.datediff(later, earlier) / 7


def _weights(weeks: Column, alpha: float) -> Column:
    """Summed weights of so many weeks."""
    w = 1.0 - alpha
    return weeks.cast("double") if w == 1 else (1 - F.pow(F.lit(w), weeks)) / alpha


def advance(state: DataFrame, norms: DataFrame, arrived: DataFrame, metric: str, alpha: float) -> tuple[DataFrame, DataFrame]:
    """(new state, changed norms) after the amounts ``arrived``.

    state: user_id, first_week, last_week, weighted; norms: user_id, week, ``metric``, ``metric``_ewma as far as they are known
    (any superset of the rows from a member's earliest arrived week on); arrived: user_id, week (a Monday), ``metric``, any
    number of rows a week.  Changed norms replace those of their (user_id, week); weeks without activity
    between a member's first and last week have 0.  Rows with a null member or week are left out.
    ``alpha`` lies above 0 and below 1.
    """
    if not 0 < alpha < 1:
        raise ValueError("alpha lies between 0 and 1")
    w, out = F.lit(1.0 - alpha), f"{metric}_ewma"
    known = F.col("user_id").isNotNull() & F.col("week").isNotNull()
    new = arrived.filter(known).groupBy("user_id", "week").agg(F.sum(F.col(metric).cast("double")).alias("_x"))
    ends = new.groupBy("user_id").agg(F.min("week").alias("_lo"), F.max("week").alias("_hi"))
    of = ends.join(state, "user_id", "left").select(
        "user_id", F.least("_lo", "first_week").alias("_first"), F.greatest("_hi", "last_week").alias("_last"),
        # weeks of silence up to the first new one are new as well
        F.least("_lo", F.date_add("last_week", 7)).alias("_from"), F.col("first_week").alias("_old_first"), F.col("last_week").alias("_old_last"),
        F.coalesce("weighted", F.lit(0.0)).alias("_weighted"))

    # what the new amounts add to the weighted sums of the weeks from _from on
    spine = of.withColumn("week", F.explode(F.sequence("_from", "_last", F.expr("INTERVAL 7 DAYS"))))
    spine = spine.join(new, ["user_id", "week"], "left").withColumn("_x", F.coalesce("_x", F.lit(0.0)))
    spine = ewma_norm(spine, "_x", alpha, out="_part")
    added = F.coalesce(F.col("_part") * _weights(_weeks("week", "_from"), alpha), F.lit(0.0))

    old = norms.select("user_id", "week", F.col(metric).cast("double").alias("_old_x"), F.col(out).alias("_old_norm"))
    both = spine.withColumn("_added", added).join(old, ["user_id", "week"], "left")
    had = F.when(F.col("week") <= F.col("_old_first"), 0.0) \
        .when(F.col("week") <= F.col("_old_last"), F.coalesce(F.col("_old_norm"), F.lit(0.0)) * _weights(_weeks("week", "_old_first"), alpha)) \
        .otherwise(F.coalesce(F.col("_weighted") * F.pow(w, _weeks("week", "_old_last") - 1), F.lit(0.0)))
    age = _weeks("week", "_first")
    changed = both.select("user_id", "week", (F.coalesce("_old_x", F.lit(0.0)) + F.col("_x")).alias(metric),
                          F.when(age > 0, (had + F.col("_added")) / _weights(age, alpha)).alias(out))

    sums = new.join(of.select("user_id", "_last"), "user_id").groupBy("user_id").agg(
        F.sum(F.pow(w, _weeks("_last", "week")) * F.col("_x")).alias("_sum"))
    carried = F.coalesce(F.col("_weighted") * F.pow(w, _weeks("_last", "_old_last")), F.lit(0.0))
    moved = of.join(sums, "user_id").select("user_id", F.col("_first").alias("first_week"), F.col("_last").alias("last_week"),
                                            (carried + F.col("_sum")).alias("weighted"))
    kept = state.join(ends.select("user_id"), "user_id", "left_anti").select("user_id", "first_week", "last_week", "weighted")
    return kept.unionByName(moved), changed
