import math
import random
from datetime import date

from pyspark.sql import functions as F

from renewlens.operators import sketches as K
from renewlens.operators import weekly as W
from renewlens.operators.quality import psi


def test_drift_from_stored_sketches_is_near_the_exact_one(spark):
    rng = random.Random(1)
    rows = [(d, rng.gauss(0.2 * (d > 4), 1), float(rng.randrange(5)), None if d % 2 else rng.random()) for d in range(10) for _ in range(3000)]
    df = spark.createDataFrame(rows, "day int, x double, y double, z double")
    kept = K.feature_sketches(df, "day", ["x", "y", "z"])
    got = {r.feature: r for r in K.sketch_drift(kept, F.col("run") < 5).collect()}
    for f in ("x", "y", "z"):
        exact = psi(df, f, F.col("day") < 5).first()
        assert got[f].baseline_rows == exact.baseline_rows and got[f].current_rows == exact.current_rows
        assert abs(got[f].psi - exact.psi) < 0.01
        assert math.isclose(sum(got[f].base_shares), 1, abs_tol=1e-9) and math.isclose(sum(got[f].cur_shares), 1, abs_tol=1e-9)
    assert got["x"].psi > 0.01 > got["z"].psi
    # any runs, merged anew from the same sketches
    some = {r.feature: r for r in K.sketch_drift(kept.filter("run in (0, 7)"), F.col("run") < 5).collect()}
    assert some["x"].baseline_rows == 3000 and "z" not in some


def test_merging_is_a_part_of_the_plan_not_of_the_rows(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 4).alias("run"), F.col("id").cast("double").alias("x"))
    path = f"file://{tmp_path}/s"
    K.feature_sketches(df, "run", ["x"]).write.parquet(path)
    merged = K.merged_sketches(spark.read.parquet(path), F.lit(True)).first()
    assert merged.n == 1000 and spark.read.parquet(path).count() == 4


def test_distinct_members_over_months(spark):
    rng = random.Random(2)
    rows = [(date(2020, rng.randrange(1, 13), 1), rng.randrange(20_000)) for _ in range(60_000)] + [(date(2020, 5, 1), None)]
    df = spark.createDataFrame(rows, "month date, user_id int")
    got = {r.last_period: r.members for r in K.distinct_over(K.distinct_sketches(df, F.col("month"), "user_id"), 3).collect()}
    assert len(got) == 12
    for last, n in got.items():
        true = len({u for m, u in rows if u is not None and 0 <= (last.month - m.month) < 3})
        assert abs(n - true) < 0.03 * true


def test_usage_factors(spark):
    from datetime import datetime

    rows = [(1, datetime(2024, 1, 1), "steps", 100.0), (1, datetime(2024, 1, 3), "steps", 50.0), (1, datetime(2024, 1, 16), "steps", 30.0), (1, datetime(2024, 1, 16), "hrm_usage", 1.0),
            (1, datetime(2024, 1, 16), "unknown", 9.0), (None, datetime(2024, 1, 16), "steps", 1.0)]
    got = W.usage_factors(spark.createDataFrame(rows, "user_id int, ts timestamp, metric string, amount double")).orderBy("week").collect()
    assert [r.steps_delta for r in got] == [None, -150.0, 30.0 - 75.0] and [r.hrm_usage_delta for r in got] == [None, 0.0, 1.0]
