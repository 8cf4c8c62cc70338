import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from renewlens.operators.asof import asof_join

DAY0 = date(2020, 1, 1)


def brute(left, right):
    out = []
    for key, day in left:
        best = None
        for rkey, rday, pid in right:
            if key is not None and day is not None and rkey == key and rday is not None and rday <= day and (best is None or (rday, pid) > best):
                best = (rday, pid)
        out.append((key, day, best and best[1]))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_against_all_pairs(spark, seed):
    rng = random.Random(seed)
    day = lambda: None if rng.random() < 0.05 else DAY0 + timedelta(days=rng.randrange(300))
    key = lambda: rng.choice([None, 1, 1, 1, 2, 3, 4])
    left = [(key(), day()) for _ in range(400)]
    right = [(key(), day(), i) for i in range(60)]
    got = asof_join(spark.createDataFrame(left, "user_id int, day date"), spark.createDataFrame(right, "user_id int, start date, pid int"),
                    "user_id", "day", "start", ["pid"], tie=["pid"])
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute(left, right)))


def test_empty_sides_and_clashing_columns(spark):
    left = spark.createDataFrame([(1, DAY0)], "user_id int, day date")
    right = spark.createDataFrame([], "user_id int, start date, pid int")
    assert [tuple(r) for r in asof_join(left, right, "user_id", "day", "start", ["pid"]).collect()] == [(1, DAY0, None)]
    assert asof_join(left.limit(0), right, "user_id", "day", "start", ["pid"]).collect() == []
    with pytest.raises(ValueError):
        asof_join(left, right.withColumn("day", F.lit(DAY0)), "user_id", "day", "start", ["day"])


def test_many_days_and_periods_of_one_member_are_no_product(spark):
    left = spark.range(10_000).select(F.lit(1).alias("user_id"), F.date_add(F.lit(DAY0), F.col("id").cast("int")).alias("day"))
    right = spark.range(1_000).select(F.lit(1).alias("user_id"), F.date_add(F.lit(DAY0), (F.col("id") * 10).cast("int")).alias("start"), F.col("id").alias("pid"))
    df = asof_join(left, right, "user_id", "day", "start", ["pid"])
    assert df.filter("pid = datediff(day, date'2020-01-01') div 10").count() == 10_000
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
