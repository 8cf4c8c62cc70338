from datetime import date

from pyspark.sql import functions as F

from renewlens.operators.calendar import calendar_dim, calendar_summary


def test_calendar_totals_2020_2030(spark):
    s = calendar_summary(calendar_dim(spark, 2020, 2030)).first()
    assert (s.total_days, s.weekend_days, s.holiday_days, s.school_break_days) == (4018, 1148, 154, 1375)
    assert s.first_day == date(2020, 1, 1) and s.last_day == date(2030, 12, 31)


def test_iso_week_edge_and_winter_wrap(spark):
    cal = calendar_dim(spark, 2020, 2021)
    r = cal.filter(F.col("dt") == date(2021, 1, 1)).first()
    assert (r.week_of_year, r.year, r.dow, r.is_weekend) == (53, 2021, 5, False)
    flags = {x.dt: x.is_school_break for x in cal.filter(F.col("dt").isin(
        date(2020, 12, 24), date(2020, 12, 25), date(2021, 1, 10), date(2021, 1, 11))).collect()}
    assert flags == {date(2020, 12, 24): False, date(2020, 12, 25): True, date(2021, 1, 10): True,
                     date(2021, 1, 11): False}
    assert cal.filter(F.col("dt") == date(2021, 1, 2)).first().season_label == "winter"
