"""Adapter shapes pinned to the counts documented in FIXTURES.md for sf0.01."""

from pyspark.sql import functions as F

from renewlens.config import DRIVER_CONFIG
from renewlens.plans.catalog import tables_for
from renewlens.plans.profile import attended_trials, earliest_trial, eligible_members, paid_member_periods
from tests.conftest import SF01


def test_fixture_counts_sf001(spark):
    a = tables_for(spark, SF01).adapters
    assert eligible_members(a.members).count() == 1302
    paid = paid_member_periods(a.periods, a.plans, DRIVER_CONFIG.paid_plans)
    assert paid.count() == 8984
    assert paid.select("user_id").distinct().count() == 1497
    assert earliest_trial(attended_trials(a.trial_attendance, a.trial_events)).count() == 1280
    types = {r.free_pass_type: r["count"] for r in a.test_accounts.groupBy("free_pass_type").count().collect()}
    assert types == {"internal": 26, "other": 96}
    status = {r.status: r["count"] for r in a.posts.groupBy("status").count().collect()}
    assert status == {"draft": 366, "posted": 1640}
    # 25 birthdays have the right shape but are impossible dates
    shaped = a.members.filter(F.col("birthday").rlike(r"^\d{2}-\d{2}-\d{4}$"))
    assert shaped.filter(F.try_to_date("birthday", "dd-MM-yyyy").isNull()).count() == 25
