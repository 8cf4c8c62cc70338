"""Property tests: Spark column expressions vs plain-Python definitions of the rules."""

from datetime import date, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from renewlens import config
from renewlens.functions.bands import band_below, right_closed_bins
from renewlens.functions.dates import age_years, in_recurring_ranges, season_of


def py_break(d: date) -> bool:
    for (sm, sd), (em, ed) in config.DEFAULT_SCHOOL_BREAKS:
        if sm > em:
            if (d.month == sm and d.day >= sd) or (d.month == em and d.day <= ed):
                return True
        elif date(d.year, sm, sd) <= d <= date(d.year, em, ed):
            return True
    return False


def py_age(b: date, a: date) -> int:
    return a.year - b.year - ((a.month, a.day) < (b.month, b.day))


dates = st.dates(min_value=date(1950, 1, 1), max_value=date(2040, 12, 31))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(dates, dates), min_size=20, max_size=60))
def test_calendar_rules_and_age(spark, pairs):
    df = spark.createDataFrame(pairs, "a date, b date")
    rows = df.select("a", "b", in_recurring_ranges("a", config.DEFAULT_SCHOOL_BREAKS).alias("brk"),
                     season_of(F.month("a")).alias("season"), age_years("b", F.col("a")).alias("age"),
                     (F.weekday("a") + 1).alias("dow"), F.weekofyear("a").alias("wk")).collect()
    for r in rows:
        assert r.brk == py_break(r.a)
        assert r.season == config.SEASON_BY_MONTH[r.a.month]
        assert r.age == py_age(r.b, r.a)
        assert r.dow == r.a.isoweekday() and r.wk == r.a.isocalendar()[1]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(min_value=-5, max_value=200, allow_nan=False)), min_size=20,
                max_size=60))
def test_bands(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    rows = df.select("x", right_closed_bins("x", config.DISTANCE_BUCKET_EDGES, config.DISTANCE_BUCKET_LABELS)
                     .alias("bucket"), band_below("x", config.DISTANCE_BANDS, config.DISTANCE_BAND_ELSE).alias("band")
                     ).collect()
    edges, labels = config.DISTANCE_BUCKET_EDGES, config.DISTANCE_BUCKET_LABELS
    for r in rows:
        if r.x is None:
            assert r.bucket is None and r.band is None
            continue
        exp = next((lab for lo, hi, lab in zip(edges[:-1], edges[1:], labels) if lo < r.x <= hi), None)
        assert r.bucket == exp
        exp_band = next((lab for e, lab in config.DISTANCE_BANDS if r.x < e), config.DISTANCE_BAND_ELSE)
        assert r.band == exp_band


def test_leap_day_years(spark):
    b = date(2000, 2, 29)
    days = [b + timedelta(days=k) for k in range(0, 365 * 30, 97)]
    df = spark.createDataFrame([(d,) for d in days], "a date")
    got = [r.age for r in df.select(age_years(F.lit(b), F.col("a")).alias("age")).collect()]
    assert got == [py_age(b, d) for d in days]
