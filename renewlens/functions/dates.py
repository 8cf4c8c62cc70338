"""Date column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from renewlens import config


def parse_day_month_year(text, pattern: str = config.BIRTHDAY_PATTERN,
                         fmt: str = config.BIRTHDAY_FORMAT) -> Column:
    """Text date guarded by a shape pattern; impossible dates give null."""
    col = F.col(text) if isinstance(text, str) else text
    return F.when(col.rlike(pattern), F.try_to_date(col, fmt))


def age_years(birth, as_of) -> Column:
    """Completed years between ``birth`` and ``as_of`` (calendar rule, leap-day safe).

    Year difference minus one when the (month, day) of ``as_of`` is before that of
    the birth date; not ``months_between / 12``.
    """
    b = F.col(birth) if isinstance(birth, str) else birth
    a = F.lit(as_of) if not isinstance(as_of, Column) else as_of
    before = (F.month(a) < F.month(b)) | ((F.month(a) == F.month(b)) & (F.dayofmonth(a) < F.dayofmonth(b)))
    return F.year(a) - F.year(b) - F.when(before, 1).otherwise(0)


def season_of(month_col, seasons: dict[int, str] = config.SEASON_BY_MONTH) -> Column:
    m = F.col(month_col) if isinstance(month_col, str) else month_col
    expr = None
    for label in dict.fromkeys(seasons.values()):
        months = [k for k, v in seasons.items() if v == label]
        expr = (F.when(m.isin(months), label) if expr is None else expr.when(m.isin(months), label))
    return expr


def in_recurring_ranges(d, ranges) -> Column:
    """True when the (month, day) of ``d`` falls in any inclusive recurring range.

    A range whose start month is after its end month wraps over New Year and covers
    only the start month from the start day and the end month up to the end day.
    """
    col = F.col(d) if isinstance(d, str) else d
    m, day = F.month(col), F.dayofmonth(col)
    md = m * 100 + day
    cond = F.lit(False)
    for (sm, sd), (em, ed) in ranges:
        if sm > em:
            cond = cond | ((m == sm) & (day >= sd)) | ((m == em) & (day <= ed))
        else:
            cond = cond | md.between(sm * 100 + sd, em * 100 + ed)
    return cond
