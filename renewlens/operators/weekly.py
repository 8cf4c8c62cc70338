"""Weekly member facts, personal norms and deltas.

Facts are keyed by (member, week): a member contributes at most one row per
calendar week, so windows partitioned by member are bounded by the calendar,
whatever the member's share of raw events.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renewlens.operators.ordered import neighbour_in_order


def week_start(ts_col: str = "ts"):
    return F.to_date(F.date_trunc("week", F.col(ts_col)))


def fact_member_week(activity: DataFrame, completed: str = "purchase", booked: Sequence[str] = ("purchase", "view"),
                     cancelled: str = "error", late_minutes: int = 15, extra: dict[str, Column] | None = None) -> DataFrame:
    """Weekly counts per member, with zero rows for silent weeks between first and last activity.

    Sessions begin on the full hour; a completed one counts as late from ``late_minutes`` after it.
    ``extra`` names further sums of doubles, zero in silent weeks.
    """
    extra = extra or {}
    et = F.col("event_type")
    facts = (activity.withColumn("week", week_start("ts"))
             .groupBy("user_id", "week")
             .agg(F.count(F.lit(1)).alias("sessions"),
                  F.sum((et == completed).cast("long")).alias("completed"),
                  F.sum(et.isin(*booked).cast("long")).alias("booked"),
                  F.sum((et == cancelled).cast("long")).alias("cancelled"),
                  F.sum(((et == completed) & (F.minute("ts") >= late_minutes)).cast("long")).alias("late"),
                  F.sum(F.hour("ts")).alias("hour_sum"),
                  F.round(F.sum("value"), 6).alias("value_sum"), *(F.sum(c).alias(k) for k, c in extra.items())))
    spine = (facts.groupBy("user_id").agg(F.min("week").alias("w0"), F.max("week").alias("w1"))
             .select("user_id", F.explode(F.sequence("w0", "w1", F.expr("INTERVAL 7 DAYS"))).alias("week")))
    zero = {c: 0 for c in ("sessions", "completed", "booked", "cancelled", "late", "hour_sum")}
    zero |= {c: 0.0 for c in ("value_sum", *extra)}
    return spine.join(facts, ["user_id", "week"], "left").fillna(zero)


def _prev_frame(key: str = "user_id", order: str = "week"):
    return Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def ewma_norm(facts: DataFrame, metric: str, alpha: float, out: str | None = None,
              key: str = "user_id", order: str = "week", block: int | None = None) -> DataFrame:
    """Exponentially weighted mean of the member's *previous* weeks with adjusted weights
    ``(1-alpha)^age``; null for the first week.

    Exact and O(weeks): rows are grouped in blocks of ``block`` consecutive weeks, where
    the numerator is a windowed prefix sum with exponents bounded by the block size (no
    overflow for any history length); the carry from earlier blocks is a fold over the
    per-block totals (a handful of rows per member); the denominator is closed-form.
    """
    out = out or f"{metric}_ewma"
    w = 1.0 - alpha
    if w <= 0:  # all weight on the last week
        last = F.lag(F.col(metric).cast("double")).over(Window.partitionBy(key).orderBy(order))
        return facts.withColumn(out, last)
    if block is None:
        block = max(1, int(250 / max(1e-9, -math.log10(w)))) if w < 1 else 1_000_000
    x = F.col(metric).cast("double")
    d = (facts.withColumn("_i", F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1)
         .withColumn("_b", F.floor(F.col("_i") / block))
         .withColumn("_j", F.col("_i") - F.col("_b") * block))
    scaled = F.pow(F.lit(w), -F.col("_j")) * x
    in_block = Window.partitionBy(key, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_p", F.coalesce(F.sum(scaled).over(in_block), F.lit(0.0)))
    wB = w ** block
    blocks = d.groupBy(key, "_b").agg((F.sum(scaled) * (w ** (block - 1))).alias("_T"))
    prev_blocks = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_S", F.aggregate(F.collect_list("_T").over(prev_blocks), F.lit(0.0),
                                                 lambda acc, t: acc * wB + t)).drop("_T")
    d = d.join(blocks, [key, "_b"])
    num = F.pow(F.lit(w), F.col("_j") - 1) * F.col("_p") + F.pow(F.lit(w), F.col("_j")) * F.col("_S")
    den = (1 - F.pow(F.lit(w), F.col("_i"))) / (1 - w) if w < 1 else F.col("_i").cast("double")
    return d.withColumn(out, F.when(F.col("_i") > 0, num / den)).drop("_i", "_b", "_j", "_p", "_S")


def quantile_norm(facts: DataFrame, metric: str) -> DataFrame:
    """25/50/75th percentile of each member's weekly history (exact)."""
    q = F.percentile(F.col(metric).cast("double"), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return (facts.groupBy("user_id").agg(q.alias("_q"))
            .select("user_id", F.col("_q")[0].alias(f"{metric}_p25"), F.col("_q")[1].alias(f"{metric}_p50"),
                    F.col("_q")[2].alias(f"{metric}_p75")))


def norm_delta(facts: DataFrame, metric: str, alpha: float) -> DataFrame:
    """actual - EWMA norm of previous weeks (negative = drop = risk)."""
    normed = ewma_norm(facts, metric, alpha)
    return normed.withColumn(f"{metric}_delta", F.col(metric) - F.col(f"{metric}_ewma"))


def completion_rate(facts: DataFrame) -> DataFrame:
    return facts.withColumn("completion_rate", F.when(F.col("booked") > 0, F.col("completed") / F.col("booked")))


def rate_deltas(facts: DataFrame) -> DataFrame:
    """Cancellation, completion, miss and late-arrival rates this week vs the member's mean of previous weeks."""
    s = F.col("sessions")
    rates = facts.withColumns({
        "cancel_rate": F.when(s > 0, F.col("cancelled") / s),
        "completion_rate": F.when(F.col("booked") > 0, F.col("completed") / F.col("booked")),
        "miss_rate": F.when(F.col("booked") > 0, (F.col("booked") - F.col("completed")) / F.col("booked")),
        "late_rate": F.when(F.col("completed") > 0, F.col("late") / F.col("completed")),
    })
    out = rates
    for r in ("cancel_rate", "completion_rate", "miss_rate", "late_rate"):
        out = out.withColumn(f"{r}_delta", F.col(r) - F.avg(r).over(_prev_frame()))
    return out


def usage_deltas(facts: DataFrame, metrics: Sequence[str] = ("sessions", "booked", "value_sum")) -> DataFrame:
    out = facts
    for m in metrics:
        out = out.withColumn(f"{m}_vs_norm", F.col(m) - F.avg(m).over(_prev_frame()))
    return out


#: Usage factors, by the metric of a usage row.
USAGE = ("time_in_app", "steps", "assessment_frequency", "hrm_usage", "weight_entries")


def usage_factors(usage: DataFrame, metrics: Sequence[str] = USAGE) -> DataFrame:
    """user_id, week and, per metric, its weekly amount minus the member's mean of all earlier weeks.

    usage: user_id, ts, metric, amount.  Weeks run from a member's first to its last usage of any metric; a week without a
    metric counts as 0; the first week has no norm.  Rows with a null member aren't used.
    """
    sums = [F.coalesce(F.sum(F.when(F.col("metric") == m, F.col("amount"))), F.lit(0.0)).alias(m) for m in metrics]
    weekly = usage.filter(F.col("user_id").isNotNull()).groupBy("user_id", week_start("ts").alias("week")).agg(*sums)
    ends = weekly.groupBy("user_id").agg(F.min("week").alias("w0"), F.max("week").alias("w1"))
    spine = ends.select("user_id", F.explode(F.sequence("w0", "w1", F.expr("INTERVAL 7 DAYS"))).alias("week"))
    full = spine.join(weekly, ["user_id", "week"], "left").fillna({m: 0.0 for m in metrics})
    return full.select("user_id", "week", *((F.col(m) - F.avg(m).over(_prev_frame())).alias(f"{m}_delta") for m in metrics))


#: Clock time as a direction: one turn a day.
_TURN = 2 * math.pi / 24
#: Directions that cancel out to less than this share of their number have no mean.
_NO_DIRECTION = 1e-9


def clock_sums(hour: Column) -> dict[str, Column]:
    """Sums that give the mean of clock times (``extra`` of ``fact_member_week``)."""
    return {"hour_sin": F.sin(hour * _TURN), "hour_cos": F.cos(hour * _TURN)}


def mean_hour(sin: Column, cos: Column, n: Column) -> Column:
    """Mean clock time (0 to 24) out of summed directions, so that 23 and 1 o'clock average to midnight; null for
    no rows and for times that cancel out (noon and midnight)."""
    hour = F.pmod(F.atan2(sin, cos) / _TURN, F.lit(24.0))
    hour = F.when(hour > 24 - 1e-9, 0.0).otherwise(hour)
    return F.when((n > 0) & (F.sqrt(sin * sin + cos * cos) > _NO_DIRECTION * n), hour)


def clock_shift(a: Column, b: Column) -> Column:
    """``a - b`` the shorter way round the clock, over -12 up to 12."""
    d = a - b
    short = d - 24 * F.ceil((d - 12) / 24)
    return F.when(F.abs(F.abs(short) - 12) < 1e-9, 12.0).otherwise(short)


def booking_time_shift(facts: DataFrame) -> DataFrame:
    """Mean booking time of the week minus that of all earlier activity, in hours the shorter way round.

    ``facts`` has the sums of ``clock_sums``.  Null where either mean has no direction.
    """
    before = mean_hour(*(F.sum(c).over(_prev_frame()) for c in ("hour_sin", "hour_cos", "sessions")))
    this = mean_hour(F.col("hour_sin"), F.col("hour_cos"), F.col("sessions"))
    return facts.withColumn("mean_hour", this).withColumn("hour_shift", clock_shift(F.col("mean_hour"), before))


def idle_gap_days(activity: DataFrame) -> DataFrame:
    """Per (member, week): the longest gap in days since the previous activity."""
    a = activity.withColumn("day", F.to_date("ts"))
    # segments of one hour: a member's burst of activity on one day still spreads over tasks
    prev = neighbour_in_order(a, "user_id", "ts", "activity_id", "day", "prev_day", direction="prev",
                              segment=F.date_trunc("hour", F.col("ts")))
    return (prev.withColumn("gap_days", F.datediff("day", "prev_day"))
            .groupBy("user_id", week_start("ts").alias("week"))
            .agg(F.max("gap_days").alias("max_idle_gap_days"), F.count(F.lit(1)).alias("sessions")))


def variety_counts(activity: DataFrame, completed: str = "purchase") -> DataFrame:
    """Distinct trainers / session types per week and days with two or more completed sessions."""
    a = activity.withColumn("week", week_start("ts")).withColumn("day", F.to_date("ts"))
    per_day = (a.filter(F.col("event_type") == completed).groupBy("user_id", "week", "day")
               .agg(F.count(F.lit(1)).alias("n")).groupBy("user_id", "week")
               .agg(F.sum((F.col("n") >= 2).cast("long")).alias("double_days")))
    distinct = (a.groupBy("user_id", "week")
                .agg(F.countDistinct("trainer_id").alias("trainers"),
                     F.countDistinct("event_type").alias("session_types")))
    return distinct.join(per_day, ["user_id", "week"], "left").fillna({"double_days": 0})


def measure_progress(measures: DataFrame) -> DataFrame:
    """Latest value minus the one before it per (member, kind of measure); null with a single value."""
    w = Window.partitionBy("user_id", "kind").orderBy(F.col("measured_at").desc(), F.col("measure_id").desc())
    top = measures.filter(F.col("measured_at").isNotNull()).withColumn("rn", F.row_number().over(w)).filter("rn <= 2")
    last, before = (F.max(F.when(F.col("rn") == i, F.col("value"))) for i in (1, 2))
    return top.groupBy("user_id", "kind").agg((last - before).alias("value_delta"))


def social_factors(profile: DataFrame, friends_col: str = "friends_cnt", posts_col: str = "feed_posts_total",
                   extrovert_min_friends: int = 10, committed_min_posts: int = 5) -> DataFrame:
    """Personality from friend count, social commitment from post count (cut-offs are parameters)."""
    return profile.select(
        "user_id",
        F.when(F.col(friends_col) >= extrovert_min_friends, "extrovert").otherwise("introvert").alias("personality"),
        F.when(F.col(posts_col) >= committed_min_posts, "committed").otherwise("casual").alias("social_commitment"))
