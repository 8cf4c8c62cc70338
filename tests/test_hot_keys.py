"""Plans and buckets under one hot key or one outlying value."""

from pyspark.sql import functions as F

from renewlens.operators import location as L
from renewlens.operators.quality import balanced_buckets, exact_quantiles


def test_one_outlier_does_not_fill_a_bucket(spark):
    n = 20_000
    values = spark.range(n).select(F.lit("x").alias("g"), (F.col("id") / 7.0).alias("v"))
    odd = spark.createDataFrame([("x", 1e300), ("x", float("inf")), ("x", float("nan")), ("x", -1e300)], "g string, v double")
    sizes = [r["count"] for r in balanced_buckets(values.unionByName(odd), "g", "v", 16).groupBy("_pid").count().collect()]
    assert len(sizes) == 16 and sum(sizes) == n + 4 and max(sizes) < 2 * n / 16
    got = {r.q: r.value for r in exact_quantiles(values.unionByName(odd), "g", "v", [0.5, 1.0], 16).collect()}
    assert abs(got[0.5] - n / 14) < 1 and got[1.0] != got[1.0]


def _cells(spark, n):
    i = F.col("id")
    return spark.range(n).select(
        (i % 1 + 1).alias("user_id"), (i * 0.001).alias("lat_r"), (i * 0.002).alias("lon_r"), (i % 5 + 1).alias("n_points"), (i * 0.001).alias("c_lat"),
        (i * 0.002).alias("c_lon"), F.lit(0).alias("night_count"), ((i * 7919) % 1000 / 3.0 + 9000).alias("cell_km"), (i % 3 / 9.0).alias("cell_var"),
        F.lit(10.0).alias("fac_lat"), F.lit(20.0).alias("fac_lon"), (i % 5 + 1).alias("score"))


def test_member_with_all_cells_needs_no_window_over_them(spark):
    df = L.member_aggregates(_cells(spark, 3000))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # the one window ranks at most two cells a member and task
    assert plan.count("Window [") == plan.count("WindowGroupLimit") == 1
    got = df.first()
    rows = _cells(spark, 3000).collect()
    n = sum(r.n_points for r in rows)
    mean = sum(r.n_points * r.cell_km for r in rows) / n
    var = sum(r.n_points * (r.cell_var + (r.cell_km - mean) ** 2) for r in rows) / n
    assert got.sample_size == n and abs(got.mean_km - mean) < 1e-9 and abs(got.std_km - var ** 0.5) < 1e-9
    assert (got.home_latitude, got.top_n) == (0.004, 5) and got.top2_min_km > 0


def test_equal_distances_have_no_spread(spark):
    df = _cells(spark, 50).withColumn("cell_km", F.lit(12345.678901234)).withColumn("cell_var", F.lit(0.0))
    assert L.member_aggregates(df).first().std_km < 1e-6


def test_points_of_a_task_are_bounded(spark, monkeypatch):
    points = spark.range(3000).select(
        (F.col("id") % 70).cast("string").alias("user_id"), (F.col("id") % 11 * 0.001 + 43).alias("latitude"),
        (F.col("id") % 7 * 0.001 + 76).alias("longitude"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id % 24 as int))").alias("created_at"))
    members = spark.range(80).select(F.col("id").cast("string").alias("user_id"), F.concat(F.lit("f"), F.col("id") % 3).alias("facility_name"))
    coords = spark.createDataFrame([("f0", 43.0, 76.0), ("f1", 43.1, 76.1)], "facility_name string, fac_lat double, fac_lon double")
    few = L.geo_metrics(points, members, coords)
    monkeypatch.setattr(L, "POINTS_PER_TASK", 100)
    many = L.geo_metrics(points, members, coords)
    assert "RepartitionByExpression" in many._jdf.queryExecution().analyzed().toString()
    assert "30" in many._jdf.queryExecution().analyzed().toString().split("RepartitionByExpression")[1].split("\n")[0]
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
