"""Geographic column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from renewlens import config


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = config.EARTH_RADIUS_KM) -> Column:
    """Great-circle distance in km (atan2 form), null if any input is null."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dlat = p2 - p1
    dlon = F.radians(lon2) - F.radians(lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(radius_km) * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def is_night(ts, utc_offset_hours: int = config.LOCAL_UTC_OFFSET_HOURS,
             from_hour: int = config.NIGHT_FROM_HOUR, to_hour: int = config.NIGHT_TO_HOUR) -> Column:
    """True when the local hour (UTC + offset) is >= from_hour or <= to_hour.

    ``ts`` may be a timestamp or a string; unparseable or missing time gives false.
    """
    col = F.col(ts) if isinstance(ts, str) else ts
    local = col.try_cast("timestamp_ntz") + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(utc_offset_hours))
    h = F.hour(local)
    return F.coalesce((h >= from_hour) | (h <= to_hour), F.lit(False))
