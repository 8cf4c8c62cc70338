from datetime import datetime, timedelta

from pyspark.sql import functions as F

from renewlens.operators import weekly as W


def test_mean_and_shift_go_round_the_clock(spark):
    rows = [([23, 1], 0.0), ([22, 23, 0, 1, 2], 0.0), ([6, 10], 8.0), ([0, 12], None), ([0, 6, 12, 18], None), ([23, 23, 1], None)]
    df = spark.createDataFrame([(i, h) for i, (hours, _) in enumerate(rows) for h in hours], "i int, h int")
    sums = df.groupBy("i").agg(*(F.sum(c).alias(k) for k, c in W.clock_sums(F.col("h")).items()), F.count("*").alias("n"))
    got = {r.i: r.m for r in sums.select("i", W.mean_hour(F.col("hour_sin"), F.col("hour_cos"), F.col("n")).alias("m")).collect()}
    for i, (hours, want) in enumerate(rows[:-1]):
        assert (got[i] is None) if want is None else min(abs(got[i] - want), 24 - abs(got[i] - want)) < 1e-9
    assert 23 < got[5] < 24
    pairs = spark.createDataFrame([(1.0, 23.0, 2.0), (23.0, 1.0, -2.0), (0.0, 12.0, 12.0), (12.0, 0.0, 12.0), (3.0, 3.0, 0.0), (13.0, 0.5, -11.5)], "a double, b double, want double")
    assert all(abs(r.d - r.want) < 1e-9 for r in pairs.select("want", W.clock_shift(F.col("a"), F.col("b")).alias("d")).collect())


def test_booking_time_shift_by_week(spark):
    monday = datetime(2024, 1, 1)
    at = [monday + timedelta(hours=23), monday + timedelta(days=1, hours=1), monday + timedelta(days=7, hours=2), monday + timedelta(days=21, hours=22)]
    a = spark.createDataFrame([(i, 7, ts, "purchase", 1.0) for i, ts in enumerate(at)], "activity_id int, user_id int, ts timestamp, event_type string, value double")
    f = W.fact_member_week(a, extra=W.clock_sums(F.hour("ts")))
    got = [(r.sessions, r.hour_shift) for r in W.booking_time_shift(f).orderBy("week").collect()]
    assert [n for n, _ in got] == [2, 1, 0, 1] and got[0][1] is None and got[2][1] is None
    assert abs(got[1][1] - 2) < 1e-9 and -3 < got[3][1] < -2
