"""Calendar dimension: one row per day, generated inside Spark."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewlens import config
from renewlens.functions.dates import in_recurring_ranges, season_of


def day_spine(bounds: DataFrame, start_col: str = "start_date", end_col: str = "end_date") -> DataFrame:
    """Explode ``[start, end]`` of each bounds row into days (bounded by the calendar span)."""
    return bounds.select(F.explode(F.sequence(F.col(start_col), F.col(end_col), F.expr("INTERVAL 1 DAY"))).alias("dt"))


def year_bounds(spark, start_year: int | Column, end_year: int | Column, source: DataFrame | None = None) -> DataFrame:
    """One row with ``start_date`` = Jan 1 of start year and ``end_date`` = Dec 31 of end year.

    Years may be columns of a one-row ``source`` (e.g. min/max year of the data).
    """
    src = source if source is not None else spark.range(1)
    sy = F.lit(start_year) if not isinstance(start_year, Column) else start_year
    ey = F.lit(end_year) if not isinstance(end_year, Column) else end_year
    return src.select(F.make_date(sy, F.lit(1), F.lit(1)).alias("start_date"),
                      F.make_date(ey, F.lit(12), F.lit(31)).alias("end_date"))


def calendar_attributes(days: DataFrame, holidays=config.DEFAULT_HOLIDAYS,
                        breaks=config.DEFAULT_SCHOOL_BREAKS, seasons=config.SEASON_BY_MONTH) -> DataFrame:
    dt = F.col("dt")
    dow = F.weekday(dt) + 1                                  # ISO: 1 = Monday
    md = F.month(dt) * 100 + F.dayofmonth(dt)
    return days.select(
        dt,
        dow.cast("short").alias("dow"),
        (dow >= 6).alias("is_weekend"),
        F.weekofyear(dt).cast("short").alias("week_of_year"),   # ISO week, calendar year kept
        F.month(dt).cast("short").alias("month"),
        F.quarter(dt).cast("short").alias("quarter"),
        F.year(dt).alias("year"),
        md.isin([m * 100 + d for m, d in holidays]).alias("is_holiday"),
        in_recurring_ranges(dt, breaks).alias("is_school_break"),
        season_of(F.month(dt), seasons).alias("season_label"),
    )


def calendar_dim(spark, start_year, end_year, holidays=config.DEFAULT_HOLIDAYS,
                 breaks=config.DEFAULT_SCHOOL_BREAKS, source: DataFrame | None = None) -> DataFrame:
    """Calendar for ``[Jan 1 start_year, Dec 31 end_year]``."""
    return calendar_attributes(day_spine(year_bounds(spark, start_year, end_year, source)), holidays, breaks)


def calendar_for_years_of(df: DataFrame, date_col: str, holidays=config.DEFAULT_HOLIDAYS,
                          breaks=config.DEFAULT_SCHOOL_BREAKS) -> DataFrame:
    """Calendar spanning the years present in ``df[date_col]`` (one aggregate, no collect)."""
    yrs = df.agg(F.min(F.year(date_col)).alias("y0"), F.max(F.year(date_col)).alias("y1"))
    return calendar_dim(df.sparkSession, F.col("y0"), F.col("y1"), holidays, breaks, source=yrs)


def calendar_summary(cal: DataFrame) -> DataFrame:
    return cal.agg(
        F.count(F.lit(1)).alias("total_days"),
        F.min("dt").alias("first_day"),
        F.max("dt").alias("last_day"),
        F.sum(F.col("is_weekend").cast("long")).alias("weekend_days"),
        F.sum(F.col("is_holiday").cast("long")).alias("holiday_days"),
        F.sum(F.col("is_school_break").cast("long")).alias("school_break_days"),
    )


def fixed_as_of(d: date) -> Column:
    return F.lit(d)
