"""Membership-period mart and the marts derived from it.

Plan: paid periods (periods join plan dimension) -> facility name (period's
facility, else the member's) -> facility correction -> freeze days
(freezes pre-aggregated per (member, period), then left-joined) -> next start
per member (segmented, see ``operators.ordered``) -> renewal fields.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewlens import config
from renewlens.config import FacilityRule
from renewlens.operators.asof import asof_join
from renewlens.operators.intervals import covered_days
from renewlens.operators.ordered import neighbour_in_order
from renewlens.operators.skew import left_join


def rules_table(spark, rules: Sequence[FacilityRule]) -> DataFrame:
    names = [r.facility for r in rules]
    if len(names) != len(set(names)):
        raise ValueError("one correction rule per facility")
    return F.broadcast(spark.createDataFrame([(r.facility, r.cutoff, r.replacement) for r in rules],
                                             "rule_facility string, cutoff date, replacement string"))


def correct_facility(df: DataFrame, name_col: str, date_col, rules: DataFrame, out: str) -> DataFrame:
    """Rename the facility to its predecessor when the reference date is before the cutoff."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    j = df.join(rules, F.col(name_col) == F.col("rule_facility"), "left")
    return (j.withColumn(out, F.when(d < F.col("cutoff"), F.col("replacement")).otherwise(F.col(name_col)))
            .drop("rule_facility", "cutoff", "replacement"))


def paid_plans(plans: DataFrame, names: Sequence[str]) -> DataFrame:
    """Paid rows of the plan dimension.  No static broadcast hint: its size decides."""
    return plans.filter(F.col("name").isin(*names)).select("plan_id", F.col("name").alias("plan_name"))


def freeze_days(freezes: DataFrame) -> DataFrame:
    """Per (member, period): sum of (end - start + 1) over freezes with both ends, else 0.

    No clipping to the period; overlapping freezes count twice; open freezes count 0.
    """
    both = F.col("start_date").isNotNull() & F.col("end_date").isNotNull()
    days = F.when(both, F.datediff("end_date", "start_date") + 1).otherwise(0)
    return freezes.groupBy("user_id", "period_id").agg(F.sum(days).cast("int").alias("freeze_days"))


def freeze_days_merged(freezes: DataFrame, periods: DataFrame) -> DataFrame:
    """Per (member, period): days of the period on which at least one freeze lies.

    Freezes are clipped to the period's days; overlapping ones count once, those without an end or with another
    member's period not at all.  Periods without such a day have no row.
    """
    dates = periods.select("user_id", "period_id", F.col("start_date").alias("_from"), F.col("end_date").alias("_to"))
    held = (freezes.filter(F.col("end_date").isNotNull()).join(dates, ["user_id", "period_id"])
            .select("user_id", "period_id", F.greatest("start_date", "_from").alias("start_date"), F.least("end_date", "_to").alias("end_date")))
    return covered_days(held, ["user_id", "period_id"], "start_date", "end_date", "freeze_days")


def next_period_start(df: DataFrame, key: str = "user_id") -> DataFrame:
    """``lead(start_date) over (partition by member order by start_date, period_id)``; null for null member."""
    return neighbour_in_order(df, key, "start_date", "period_id", "start_date", "next_start", direction="next")


def renewal_fields(df: DataFrame) -> DataFrame:
    days = F.datediff("next_start", "end_corrected")
    renewed = F.col("next_start").isNotNull()
    return df.withColumns({"days_to_next": days, "renewed": renewed, "gap_days": F.when(renewed, days)})


def paid_periods_with_facility(periods: DataFrame, plans: DataFrame, members: DataFrame, facilities: DataFrame,
                               rules: DataFrame, paid: Sequence[str], spread_null_members: bool = True) -> DataFrame:
    fac = facilities.groupBy("facility_id").agg(F.min("name").alias("name"))
    p = periods.join(paid_plans(plans, paid), "plan_id")
    p = p.join(fac.withColumnRenamed("name", "p_fac"), "facility_id", "left")
    home = members.select("user_id", F.col("facility_id").alias("m_fid"))
    # a member with many periods is left to AQE; periods without a member are spread
    p = left_join(p, home, "user_id", ["period_id"]) if spread_null_members else p.join(home, "user_id", "left")
    p = (p.join(fac.select(F.col("facility_id").alias("m_fid"), F.col("name").alias("m_fac")), "m_fid", "left"))
    p = p.withColumn("fac_name", F.coalesce("p_fac", "m_fac"))
    return correct_facility(p, "fac_name", "start_date", rules, "facility_corr")


def period_mart(periods: DataFrame, plans: DataFrame, freezes: DataFrame, members: DataFrame,
                facilities: DataFrame, rules: DataFrame, paid: Sequence[str], merge_overlaps: bool = False,
                spread_null_members: bool = True) -> DataFrame:
    """One row per paid period.  ``merge_overlaps`` counts each frozen day of the period once; else the lengths of
    its freezes are added up, as they are.  Without ``spread_null_members`` periods and members join on the
    member alone, which tables bucketed by it do without an exchange."""
    p = paid_periods_with_facility(periods, plans, members, facilities, rules, paid, spread_null_members)
    frozen = freeze_days_merged(freezes, periods) if merge_overlaps else freeze_days(freezes)
    p = (p.join(frozen, ["user_id", "period_id"], "left")
         .withColumn("freeze_days", F.coalesce("freeze_days", F.lit(0))))
    p = p.select("period_id", "user_id", "plan_name", "facility_corr", "start_date", "end_date", "freeze_days",
                 F.date_add("end_date", F.col("freeze_days")).alias("end_corrected"),
                 (F.datediff("end_date", "start_date") + 1).alias("length_days"))
    return renewal_fields(next_period_start(p))


def renewal_summary(mart: DataFrame) -> DataFrame:
    renewed = F.col("renewed")
    return mart.agg(
        F.count(F.lit(1)).alias("periods"),
        F.countDistinct("user_id").alias("members"),
        F.sum(renewed.cast("long")).alias("renewed_periods"),
        F.round(F.avg("freeze_days"), 6).alias("avg_freeze_days"),
        F.round(F.avg(F.when(renewed, F.col("gap_days"))), 6).alias("avg_gap_days_renewed"),
        F.round(F.sum(renewed.cast("long")) * 100.0 / F.count(F.lit(1)), 6).alias("renewed_pct"),
    )


def renewed_counts(mart: DataFrame) -> DataFrame:
    return mart.groupBy("renewed").agg(F.count(F.lit(1)).alias("periods"))


def renewal_labels(mart: DataFrame, as_of: date, windows: Sequence[int] = config.LABEL_WINDOWS_DAYS) -> DataFrame:
    """renewed_within_k: true if the next period starts (by ``as_of``) no later than corrected
    end + k days (early renewals included); null while the window is still open; else false."""
    cols = [renewed_within(as_of, k).alias(f"renewed_{k}d") for k in windows]
    return mart.select("period_id", "user_id", "end_corrected", "next_start", *cols)


def renewed_within(as_of: date, days: int) -> F.Column:
    """The label of one window, from columns of the mart."""
    a, horizon = F.lit(as_of), F.date_add("end_corrected", days)
    seen_next = F.when(F.col("next_start") <= a, F.col("next_start"))
    return F.when(seen_next <= horizon, True).when(a < horizon, F.lit(None)).otherwise(False)


def spells(mart: DataFrame, as_of: date, window_days: int = 30, covariates: Sequence[str] = ()) -> DataFrame:
    """Periods begun by ``as_of``: weeks held until min(corrected end, as_of), and whether the member is known
    not to have renewed within ``window_days``; ``covariates`` of the mart as doubles."""
    a = F.lit(as_of)
    horizon = F.date_add("end_corrected", window_days)
    churned = (horizon <= a) & ~F.coalesce((F.col("next_start") <= horizon) & (F.col("next_start") <= a), F.lit(False))
    weeks = F.floor(F.datediff(F.least(F.col("end_corrected"), a), "start_date") / 7).cast("int") + 1
    return mart.filter(F.col("start_date") <= a).select(
        "period_id", "user_id", F.month("start_date").cast("double").alias("start_month"), weeks.alias("weeks"), churned.alias("churned"),
        *(F.col(c).cast("double").alias(c) for c in covariates))


def week_in_period(day: F.Column) -> F.Column:
    """Whole weeks from the period's start to ``day``; null before its start and after its corrected end."""
    return F.when(day.between(F.col("start_date"), F.col("end_corrected")), F.floor(F.datediff(day, "start_date") / 7).cast("int"))


def completion_per_period(activity: DataFrame, mart: DataFrame, completed: str = "purchase",
                          booked: Sequence[str] = ("purchase", "view")) -> DataFrame:
    """Completed / booked sessions of each period: an activity belongs to the member's period started last by
    its day (by period id, if several start then).  Null where nothing was booked.

    Activity is reduced to one row per (member, day); the period begun last is carried forward to each day
    (``operators.asof``), so days don't meet all periods of their member.
    """
    et = F.col("event_type")
    days = (activity.groupBy("user_id", F.to_date("ts").alias("day"))
            .agg(F.count_if(et.isin(*booked)).alias("n_booked"), F.count_if(et == completed).alias("n_completed")).filter("n_booked > 0"))
    held = asof_join(days, mart, "user_id", "day", "start_date", ["period_id"], tie=["period_id"]).filter("period_id is not null")
    sums = held.groupBy("period_id").agg(F.sum("n_booked").alias("booked"), F.sum("n_completed").alias("completed"))
    rate = F.when(F.col("booked") > 0, F.col("completed") / F.col("booked"))
    return mart.select("period_id", "user_id").join(sums, "period_id", "left").withColumn("completion_rate", rate)


def survival_intervals(mart: DataFrame, as_of: date, window_days: int = 30) -> DataFrame:
    """One row per (period, week) from start to min(corrected end, as_of); ``event`` is set on the
    last week of periods that ended and were not renewed within ``window_days``."""
    base = spells(mart, as_of, window_days).withColumnRenamed("weeks", "n_weeks")
    return (base.select("period_id", "user_id", "n_weeks", "churned",
                        F.posexplode(F.sequence(F.lit(0), F.col("n_weeks") - 1)).alias("week_index", "_w"))
            .select("period_id", "user_id", "week_index",
                    ((F.col("week_index") == F.col("n_weeks") - 1) & F.col("churned")).alias("event")))


def freeze_features(freezes: DataFrame) -> DataFrame:
    """Per freeze: attempt number per member (rank by start, period, end) and running freeze
    days including ties — segmented by start date, so a member's freezes spread over tasks."""
    from renewlens.operators.ordered import running_in_order

    both = F.col("start_date").isNotNull() & F.col("end_date").isNotNull()
    days = F.when(both, F.datediff("end_date", "start_date") + 1).otherwise(0)
    f = freezes.select("user_id", "period_id", "start_date", "end_date", days.alias("days"))
    return running_in_order(f, "user_id", ["start_date", "period_id", "end_date"], rank_col="attempt_no",
                            sum_col="days", sum_out="days_used", rank_fn="rank")
