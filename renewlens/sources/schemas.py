"""Mart schemas and ``conform``: select, cast (decimals round at the sink) and defaults."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PERIOD_MART = T.StructType([
    T.StructField("period_id", T.StringType(), False),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("plan_name", T.StringType(), True),
    T.StructField("facility_corr", T.StringType(), True),
    T.StructField("start_date", T.DateType(), False),
    T.StructField("end_date", T.DateType(), False),
    T.StructField("end_corrected", T.DateType(), False),
    T.StructField("length_days", T.IntegerType(), True),
    T.StructField("freeze_days", T.IntegerType(), True),
    T.StructField("next_start", T.DateType(), True),
    T.StructField("days_to_next", T.IntegerType(), True),
    T.StructField("renewed", T.BooleanType(), True),
    T.StructField("gap_days", T.IntegerType(), True),
])
PERIOD_MART_DEFAULTS = {"freeze_days": 0}

CALENDAR = T.StructType([
    T.StructField("dt", T.DateType(), False),
    T.StructField("dow", T.ShortType(), False),
    T.StructField("is_weekend", T.BooleanType(), False),
    T.StructField("week_of_year", T.ShortType(), False),
    T.StructField("month", T.ShortType(), False),
    T.StructField("quarter", T.ShortType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("is_holiday", T.BooleanType(), True),
    T.StructField("is_school_break", T.BooleanType(), True),
    T.StructField("season_label", T.StringType(), True),
])
CALENDAR_DEFAULTS = {"is_holiday": False, "is_school_break": False}

GEO_METRICS = T.StructType([
    T.StructField("user_id", T.StringType(), False),
    T.StructField("home_latitude", T.DecimalType(10, 7), True),
    T.StructField("home_longitude", T.DecimalType(10, 7), True),
    T.StructField("home_location_confidence", T.DecimalType(5, 2), True),
    T.StructField("location_sample_size", T.IntegerType(), True),
    T.StructField("distance_home_to_club_km", T.DecimalType(6, 2), True),
    T.StructField("avg_booking_distance_km", T.DecimalType(6, 2), True),
    T.StructField("min_booking_distance_km", T.DecimalType(6, 2), True),
    T.StructField("distance_variability", T.DecimalType(6, 2), True),
    T.StructField("is_home_nearby", T.BooleanType(), True),
    T.StructField("commute_convenience_score", T.DecimalType(5, 4), True),
    T.StructField("location_data_quality", T.StringType(), True),
])
GEO_DEFAULTS = {"location_sample_size": 0, "is_home_nearby": False, "location_data_quality": "none"}

PROFILE = T.StructType(
    [T.StructField("user_id", T.StringType(), False)]
    + [T.StructField(c, T.StringType()) for c in ("nickname", "firstname", "lastname", "gender", "birthday")]
    + [T.StructField("age", T.IntegerType()), T.StructField("age_band", T.StringType()),
       T.StructField("phone", T.StringType()), T.StructField("created_date", T.DateType()),
       T.StructField("weight_kg", T.DecimalType(6, 2)), T.StructField("height_cm", T.DecimalType(6, 2)),
       T.StructField("fat_pct_latest", T.DecimalType(5, 2)), T.StructField("bmi_latest", T.DecimalType(5, 2)),
       T.StructField("facility_corr", T.StringType()), T.StructField("city", T.StringType()),
       T.StructField("in_group", T.BooleanType()), T.StructField("friends_cnt", T.IntegerType()),
       T.StructField("feed_posts_total", T.IntegerType()), T.StructField("lifestyle_flag", T.BooleanType()),
       T.StructField("bodytype", T.StringType()), T.StructField("goal", T.StringType())]
    + [T.StructField(f"{o}_{part}", kind) for o in ("first", "second", "third", "fourth", "fifth")
       for part, kind in (("start", T.DateType()), ("end", T.DateType()), ("plan", T.StringType()))]
    + [T.StructField("ever_member", T.BooleanType()), T.StructField("trial_before_first", T.BooleanType()),
       T.StructField("trial_type", T.StringType()), T.StructField("trial_payment", T.StringType())]
    + GEO_METRICS.fields[1:]
    + [T.StructField("created_at", T.TimestampNTZType()), T.StructField("updated_at", T.TimestampNTZType())])
PROFILE_DEFAULTS = {"in_group": False, "friends_cnt": 0, "feed_posts_total": 0, "ever_member": False,
                    "trial_before_first": False, **GEO_DEFAULTS}


def conform(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Project ``df`` onto ``schema``: missing columns become null (or their default),
    values are cast to the column type, nulls are filled with the defaults."""
    defaults = defaults or {}
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name in defaults:
            c = F.coalesce(c, F.lit(defaults[f.name]))
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)
