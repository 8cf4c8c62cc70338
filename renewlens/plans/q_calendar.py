"""Calendar queries.  The calendar spans the years of the order (period) data,
so it is derived from the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from renewlens import config
from renewlens.operators.calendar import calendar_for_years_of, calendar_summary
from renewlens.plans.periods import week_in_period
from renewlens.plans.catalog import register
from renewlens.plans.q_periods import MART_WITH, mart

HOL = ", ".join(str(m * 100 + d) for m, d in config.DEFAULT_HOLIDAYS)


def _break_sql(col="dt"):
    parts = []
    for (sm, sd), (em, ed) in config.DEFAULT_SCHOOL_BREAKS:
        if sm > em:
            parts.append(f"(month({col}) = {sm} AND day({col}) >= {sd}) OR (month({col}) = {em} AND day({col}) <= {ed})")
        else:
            parts.append(f"(month({col}) * 100 + day({col}) BETWEEN {sm * 100 + sd} AND {em * 100 + ed})")
    return " OR ".join(parts)


CAL_CTES = f"""
bounds AS (SELECT min(year(o_orderdate)) AS y0, max(year(o_orderdate)) AS y1 FROM orders),
days AS (SELECT CAST(unnest(generate_series(make_date(y0, 1, 1), make_date(y1, 12, 31), INTERVAL 1 DAY)) AS DATE) AS dt
         FROM bounds),
cal AS (
  SELECT dt, CAST(isodow(dt) AS SMALLINT) AS dow, isodow(dt) >= 6 AS is_weekend,
         CAST(weekofyear(dt) AS SMALLINT) AS week_of_year, CAST(month(dt) AS SMALLINT) AS month,
         CAST(quarter(dt) AS SMALLINT) AS quarter, year(dt) AS year,
         (month(dt) * 100 + day(dt)) IN ({HOL}) AS is_holiday,
         ({_break_sql()}) AS is_school_break,
         CASE WHEN month(dt) IN (12, 1, 2) THEN 'winter' WHEN month(dt) IN (3, 4, 5) THEN 'spring'
              WHEN month(dt) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season_label
  FROM days)"""
CAL_WITH = "WITH " + CAL_CTES.strip() + "\n"


def calendar(t):
    return calendar_for_years_of(t.orders, "o_orderdate")


@register("calendar_dim", CAL_WITH + "SELECT * FROM cal")
def calendar_dim(t):
    """One row per day over the years of the data: ISO dow/week, flags, season."""
    return calendar(t)


@register("generate_calendar", CAL_WITH + "SELECT dt FROM cal")
def generate_calendar(t):
    """Day spine [Jan 1 first year, Dec 31 last year] via sequence + explode."""
    return calendar(t).select("dt")


@register("calendar_summary", CAL_WITH + """
SELECT count(*) AS total_days, min(dt) AS first_day, max(dt) AS last_day,
       sum(CAST(is_weekend AS BIGINT)) AS weekend_days, sum(CAST(is_holiday AS BIGINT)) AS holiday_days,
       sum(CAST(is_school_break AS BIGINT)) AS school_break_days
FROM cal""")
def calendar_summary_q(t):
    """Total days, first/last day, weekend, holiday and school-break day counts."""
    return calendar_summary(calendar(t))


@register("holiday_rows", CAL_WITH + "SELECT dt, dow, season_label FROM cal WHERE is_holiday")
def holiday_rows(t):
    """Calendar rows flagged as public holidays."""
    return calendar(t).filter("is_holiday").select("dt", "dow", "season_label")


@register("first_holidays", CAL_WITH + "SELECT dt, dow FROM cal WHERE is_holiday ORDER BY dt LIMIT 10")
def first_holidays(t):
    """First 10 holidays (top-k is the feature)."""
    return calendar(t).filter("is_holiday").select("dt", "dow").orderBy("dt").limit(10)


@register("calendar_features", MART_WITH.replace("WITH ", "WITH " + CAL_CTES.strip() + ",\n", 1) + """
SELECT m.period_id, m.user_id, c.season_label AS start_season, c.is_holiday AS start_is_holiday,
       c.is_school_break AS start_in_school_break, CAST(floor(m.length_days / 7) AS INTEGER) AS weeks_in_period,
       CASE WHEN DATE '1998-01-01' BETWEEN m.start_date AND m.end_corrected
            THEN CAST((DATE '1998-01-01' - m.start_date) // 7 AS INTEGER) END AS week_in_period
FROM mart m LEFT JOIN cal c ON m.start_date = c.dt""")
def calendar_features(t):
    """External seasonality (calendar attributes of the period start) and internal (weeks in period, and the
    week within it on a day: null outside)."""
    cal = calendar(t).select("dt", "season_label", "is_holiday", "is_school_break")
    m = mart(t)
    return (m.join(cal, m.start_date == cal.dt, "left")
            .select("period_id", "user_id", F.col("season_label").alias("start_season"),
                    F.col("is_holiday").alias("start_is_holiday"),
                    F.col("is_school_break").alias("start_in_school_break"),
                    F.floor(F.col("length_days") / 7).cast("int").alias("weeks_in_period"),
                    week_in_period(F.lit(date(1998, 1, 1))).alias("week_in_period")))
