"""SQL surface: the raw-shape tables and the marts as temporary views.

Users who query marts with SQL keep doing so through ``spark.sql``; the views are
lazy plans (nothing is computed when they are registered).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import SparkSession

from renewlens import config
from renewlens.config import DomainConfig
from renewlens.operators.calendar import calendar_for_years_of
from renewlens.plans.catalog import tables_for
from renewlens.plans.periods import period_mart, rules_table
from renewlens.plans.profile import asked_answers, attended_trials, location_metrics, member_profile

RAW = ("members", "facilities", "facility_names", "plans", "periods", "freezes", "trial_events", "trial_attendance", "payments",
       "body_tests", "measures", "friend_counts", "posts", "groups", "questions", "test_accounts", "member_locations",
       "activity", "scores")


def register_views(spark: SparkSession, sf_dir: str, cfg: DomainConfig = config.DRIVER_CONFIG,
                   as_of: date = config.PERIOD_AS_OF, prefix: str = "") -> list[str]:
    """Create temp views for the raw-shape tables and the marts; returns the view names."""
    t = tables_for(spark, sf_dir)
    a = t.adapters
    names = []
    for n in RAW:
        getattr(a, n).createOrReplaceTempView(prefix + n)
        names.append(prefix + n)
    marts = {
        "trials": attended_trials(a.trial_attendance, a.trial_events),
        "answers": asked_answers(a.answers, a.questions),
        "period_mart": period_mart(a.periods, a.plans, a.freezes, a.members, a.facilities,
                                   rules_table(spark, cfg.facility_rules), cfg.paid_plans),
        "calendar": calendar_for_years_of(t.orders, "o_orderdate"),
        "location_metrics": location_metrics(a, cfg),
    }
    marts["member_profile"] = member_profile(a, cfg, as_of, spark, geo=marts["location_metrics"])
    for n, df in marts.items():
        df.createOrReplaceTempView(prefix + n)
        names.append(prefix + n)
    return names
