"""Location score and quality expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from renewlens import config


def commute_score(distance_km, variability_km) -> Column:
    """1 - (0.7*min(1, d/10) + 0.3*min(1, sd/5)) clamped to [0, 1], 4 decimals."""
    d = F.col(distance_km) if isinstance(distance_km, str) else distance_km
    v = F.col(variability_km) if isinstance(variability_km, str) else variability_km
    raw = 1.0 - (config.COMMUTE_DIST_WEIGHT * F.least(F.lit(1.0), d / config.COMMUTE_DIST_SCALE_KM)
                 + config.COMMUTE_VAR_WEIGHT * F.least(F.lit(1.0), v / config.COMMUTE_VAR_SCALE_KM))
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw)), 4)


def geo_quality(has_facility_coords, sample_size, confidence) -> Column:
    """Quality ladder: no_club_coords, no_user_data, insufficient, good, medium, poor."""
    n = F.col(sample_size) if isinstance(sample_size, str) else sample_size
    c = F.col(confidence) if isinstance(confidence, str) else confidence
    hc = F.col(has_facility_coords) if isinstance(has_facility_coords, str) else has_facility_coords
    g_n, g_c = config.QUALITY_GOOD
    m_n, m_c = config.QUALITY_MEDIUM
    return (F.when(~hc, "no_club_coords")
            .when(F.coalesce(n, F.lit(0)) == 0, "no_user_data")
            .when(n < config.MIN_POINTS_FOR_STATS, "insufficient")
            .when((n >= g_n) & (c >= g_c), "good")
            .when((n >= m_n) & (c >= m_c), "medium")
            .otherwise("poor"))
