import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from renewlens.functions import commute_score, geo_quality, haversine_km, is_night, right_closed_bins
from renewlens.functions.dates import age_years, parse_day_month_year
from renewlens import config
from renewlens.operators.scoring import intervention_level, risk_band
from renewlens.plans.profile import age_band


def test_age_on_leap_birthday(spark):
    df = spark.createDataFrame([("29-02-2000", date(2023, 2, 28)), ("29-02-2000", date(2023, 3, 1)),
                                ("31-02-2000", date(2023, 3, 1)), ("2000/01/02", date(2023, 3, 1))],
                               "b string, as_of date")
    b = parse_day_month_year("b")
    rows = df.select(b.alias("bd"), F.when(b.isNotNull(), age_years(b, F.col("as_of"))).alias("age")).collect()
    assert [r.age for r in rows] == [22, 23, None, None]
    assert rows[2].bd is None
    bands = df.select(age_band(F.lit(None).cast("int")).alias("x")).first().x
    assert bands == "unknown"


@pytest.mark.parametrize("age,band", [(17, "<18"), (18, "18-24"), (24, "18-24"), (25, "25-34"), (64, "55-64"),
                                      (65, "65+")])
def test_age_bands(spark, age, band):
    assert spark.range(1).select(age_band(F.lit(age)).alias("b")).first().b == band


def test_night_edges(spark):
    ts = [datetime(2024, 1, 1, 3, 59), datetime(2024, 1, 1, 4, 0), datetime(2024, 1, 1, 16, 59),
          datetime(2024, 1, 1, 17, 0), None]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    assert [r.n for r in df.select(is_night("ts").alias("n")).collect()] == [True, False, False, True, False]


def test_night_from_text(spark):
    df = spark.createDataFrame([("2024-01-01 17:30:00",), ("garbage",)], "ts string")
    got = df.select(is_night("ts").alias("n")).collect()
    assert [r.n for r in got] == [True, False]


@pytest.mark.parametrize("d,v,expected", [(3.60, 46.68, 0.4480), (5, 1, 0.59), (5, 10, 0.35), (1.5, 0.5, 0.865),
                                          (0, 0, 1.0), (20, 9, 0.0)])
def test_commute_score(spark, d, v, expected):
    got = spark.range(1).select(commute_score(F.lit(float(d)), F.lit(float(v))).alias("s")).first().s
    assert math.isclose(got, expected, abs_tol=1e-9)


@pytest.mark.parametrize("n,c,q", [(20, 30.0, "good"), (19, 30.0, "medium"), (10, 20.0, "medium"),
                                   (9, 100.0, "poor"), (2, 100.0, "insufficient"), (0, None, "no_user_data")])
def test_quality_ladder(spark, n, c, q):
    got = spark.range(1).select(geo_quality(F.lit(True), F.lit(n), F.lit(c).cast("double")).alias("q")).first().q
    assert got == q


def test_quality_no_coords(spark):
    got = spark.range(1).select(geo_quality(F.lit(False), F.lit(50), F.lit(90.0)).alias("q")).first().q
    assert got == "no_club_coords"


def test_distance_bucket(spark):
    vals = [0.0, 0.5, 1.0, 1.01, 100.0, 101.0]
    df = spark.createDataFrame([(v,) for v in vals], "d double")
    got = [r.b for r in df.select(right_closed_bins("d", config.DISTANCE_BUCKET_EDGES,
                                                    config.DISTANCE_BUCKET_LABELS).alias("b")).collect()]
    assert got == [None, "<1km", "<1km", "1-2km", ">10km", None]


def test_haversine_matches_python(spark):
    def py(lat1, lon1, lat2, lon2):
        p1, p2 = math.radians(lat1), math.radians(lat2)
        a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(
            (math.radians(lon2) - math.radians(lon1)) / 2) ** 2
        return 6371.0 * 2 * math.atan2(math.sqrt(a), math.sqrt(1 - a))

    pts = (43.2398, 76.9527, 51.1403, 71.4103)
    got = spark.range(1).select(haversine_km(*[F.lit(x) for x in pts]).alias("d")).first().d
    assert math.isclose(got, py(*pts), rel_tol=1e-12)


def test_risk_bands(spark):
    ps = [0.0, 0.2999, 0.3, 0.5, 0.7, 0.85, 1.0]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = [r.b for r in df.select(risk_band("p").alias("b")).collect()]
    assert got == ["very_high", "very_high", "high", "medium", "low", "very_low", "very_low"]
    lv = [r.i for r in df.select(intervention_level("p").alias("i")).collect()]
    assert lv == ["critical", "critical", "warning", "watch", "none", "none", "none"]


def test_exact_mean_half_up_and_order_independent(spark):
    from decimal import ROUND_HALF_UP, Decimal

    from renewlens.functions.stats import exact_mean

    vals = [43.2037 + 0.00001 * (i % 3) for i in range(1, 4001)] + [0.1] * 7
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got1 = df.repartition(7).agg(exact_mean("x").alias("m")).first().m
    got2 = df.repartition(3).agg(exact_mean("x").alias("m")).first().m
    exact = sum(Decimal(repr(v)).quantize(Decimal("1e-10")) for v in vals) / len(vals)
    ref = float(exact.quantize(Decimal("1e-12"), rounding=ROUND_HALF_UP))
    assert got1 == got2 == ref
