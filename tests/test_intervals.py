import random
from datetime import date, timedelta

import pytest

from renewlens.operators.intervals import covered_days, merged_intervals
from renewlens.plans import periods as P

DAY0 = date(2020, 1, 1)


def frozen(rows):
    days = {}
    for key, a, b in rows:
        if a is not None and b is not None and a <= b:
            days.setdefault(key, set()).update(a + timedelta(days=i) for i in range((b - a).days + 1))
    return days


@pytest.mark.parametrize("seed, span", [(0, 3), (1, 40), (2, 120)])
def test_against_counting_days(spark, seed, span):
    rng = random.Random(seed)
    rows = []
    for _ in range(300):
        a = None if rng.random() < 0.05 else DAY0 + timedelta(days=rng.randrange(500))
        b = None if a is None or rng.random() < 0.1 else a + timedelta(days=rng.randrange(-2, span))
        rows.append((rng.choice([None, 1, 1, 2, 3]), a, b))
    df = spark.createDataFrame(rows, "user_id int, a date, b date")
    days = frozen(rows)
    assert {r.user_id: r.days for r in covered_days(df, ["user_id"], "a", "b").collect()} == {k: len(v) for k, v in days.items()}
    want = set()
    for key, held in days.items():
        for d in held:
            if d - timedelta(days=1) not in held:
                e = d
                while e + timedelta(days=1) in held:
                    e += timedelta(days=1)
                want.add((key, d, e))
    got = [tuple(r) for r in merged_intervals(df, ["user_id"], "a", "b").select("user_id", "a", "b").collect()]
    assert len(got) == len(want) and set(got) == want
    assert covered_days(df.limit(0), ["user_id"], "a", "b").collect() == []


def test_freezes_are_clipped_to_their_period(spark):
    d = lambda i: DAY0 + timedelta(days=i)
    periods = spark.createDataFrame([(1, 10, d(0), d(9)), (2, 20, d(0), d(9))], "user_id int, period_id int, start_date date, end_date date")
    freezes = spark.createDataFrame([(1, 10, d(-5), d(2)), (1, 10, d(2), d(3)), (1, 10, d(8), d(30)), (1, 10, d(4), None), (2, 20, d(40), d(50)), (3, 10, d(0), d(5))],
                                    "user_id int, period_id int, start_date date, end_date date")
    assert [tuple(r) for r in P.freeze_days_merged(freezes, periods).collect()] == [(1, 10, 6)]
