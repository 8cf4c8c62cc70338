from datetime import date

from pyspark.sql import functions as F

from renewlens.config import FacilityRule
from renewlens.plans import periods as P

PERIOD_SCHEMA = "period_id long, user_id long, plan_id string, facility_id int, start_date date, end_date date"


def _mart(spark, periods, freezes, rules=()):
    plans = spark.createDataFrame([("p", "annual")], "plan_id string, name string")
    members = spark.createDataFrame([(1, 0), (2, 0)], "user_id long, facility_id int")
    fac = spark.createDataFrame([(0, "F0", None, None), (1, "F1", None, None)],
                                "facility_id int, name string, lat double, lon double")
    fr = spark.createDataFrame(freezes, "user_id long, period_id long, start_date date, end_date date")
    return P.period_mart(spark.createDataFrame(periods, PERIOD_SCHEMA), plans, fr, members, fac,
                         P.rules_table(spark, rules), ["annual"])


def test_freeze_sum_and_renewal_fields(spark):
    periods = [(10, 1, "p", 0, date(2024, 1, 1), date(2024, 12, 30)),
               (11, 1, "p", 0, date(2025, 1, 5), date(2025, 12, 30))]
    freezes = [(1, 10, date(2024, 3, 1), date(2024, 3, 10)), (1, 10, date(2024, 3, 5), date(2024, 3, 6)),
               (1, 10, date(2024, 4, 1), None), (2, 10, date(2024, 5, 1), date(2024, 5, 30))]
    r = {x.period_id: x for x in _mart(spark, periods, freezes).collect()}
    assert r[10].freeze_days == 12                       # overlap double counted, open freeze 0, other member ignored
    assert r[10].end_corrected == date(2025, 1, 11)
    assert r[10].length_days == 365
    assert r[10].next_start == date(2025, 1, 5)
    assert r[10].days_to_next == -6 and r[10].renewed is True and r[10].gap_days == -6
    assert r[11].next_start is None and r[11].renewed is False and r[11].gap_days is None


def test_null_member_gets_no_next(spark):
    periods = [(1, None, "p", 0, date(2024, 1, 1), date(2024, 2, 1)),
               (2, None, "p", 0, date(2024, 3, 1), date(2024, 4, 1))]
    rows = _mart(spark, periods, []).collect()
    assert len(rows) == 2
    assert all(r.next_start is None and r.renewed is False for r in rows)


def test_facility_rule_edge(spark):
    rules = [FacilityRule("F0", date(2024, 1, 10), "F1")]
    periods = [(1, 1, "p", 0, date(2024, 1, 10), date(2024, 2, 1)),
               (2, 2, "p", 0, date(2024, 1, 9), date(2024, 2, 1)),
               (3, 1, "p", None, date(2023, 1, 1), date(2023, 2, 1))]   # facility from the member
    r = {x.period_id: x.facility_corr for x in _mart(spark, periods, [], rules).collect()}
    assert r == {1: "F0", 2: "F1", 3: "F1"}


def test_renewal_labels(spark):
    mart = spark.createDataFrame(
        [(1, 1, date(2024, 1, 31), date(2024, 3, 5)), (2, 2, date(2024, 12, 15), None)],
        "period_id long, user_id long, end_corrected date, next_start date")
    r = {x.period_id: x for x in P.renewal_labels(mart, date(2024, 12, 31)).collect()}
    assert (r[1].renewed_30d, r[1].renewed_60d, r[1].renewed_90d) == (False, True, True)
    assert (r[2].renewed_30d, r[2].renewed_60d, r[2].renewed_90d) == (None, None, None)


def test_survival_intervals_event_on_last_week(spark):
    mart = spark.createDataFrame([(1, 1, date(2024, 1, 1), date(2024, 1, 20), None)],
                                 "period_id long, user_id long, start_date date, end_corrected date, next_start date")
    rows = sorted(P.survival_intervals(mart, date(2024, 6, 1)).collect(), key=lambda r: r.week_index)
    assert [r.week_index for r in rows] == [0, 1, 2]
    assert [r.event for r in rows] == [False, False, True]


def test_freeze_days_skips_open(spark):
    fr = spark.createDataFrame([(1, 1, date(2024, 1, 1), None), (1, 1, None, date(2024, 1, 3))],
                               "user_id long, period_id long, start_date date, end_date date")
    assert P.freeze_days(fr).collect()[0].freeze_days == 0
    assert fr.filter(F.col("start_date").isNull()).count() == 1
