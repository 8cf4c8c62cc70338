"""Column expressions.  Everything returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen."""

from renewlens.functions.bands import band_below, right_closed_bins
from renewlens.functions.dates import age_years, parse_day_month_year, season_of, in_recurring_ranges
from renewlens.functions.geo import haversine_km, is_night
from renewlens.functions.scores import commute_score, geo_quality

__all__ = [
    "age_years", "band_below", "commute_score", "geo_quality", "haversine_km", "in_recurring_ranges",
    "is_night", "parse_day_month_year", "right_closed_bins", "season_of",
]
