import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from renewlens.config import AnswerRules
from renewlens.operators.location import geo_metrics, home_clusters, home_location
from renewlens.operators.ordered import neighbour_in_order
from renewlens.operators.ranking import earliest_by, first_k_pivot, latest_by
from renewlens.operators.semijoin import exclude, exists_flag, membership_flag
from renewlens.operators.survey import answer_classify
from renewlens.operators.weekly import ewma_norm


def _rows(n, keys, seed, null_every=0, hot=None):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        k = hot if hot is not None and rnd.random() < 0.4 else rnd.randrange(keys)
        if null_every and i % null_every == 0:
            k = None
        d = date(2024, 1, 1) + timedelta(days=rnd.randrange(30))
        out.append((i, k, d if rnd.random() > 0.1 else None))
    return out


def test_latest_by_matches_window(spark):
    df = spark.createDataFrame(_rows(2000, 20, 1, hot=3), "id long, k long, d date")
    w = Window.partitionBy("k").orderBy(F.col("d").desc_nulls_last(), F.col("id").desc())
    ref = {(r.k, r.id) for r in df.withColumn("rn", F.row_number().over(w)).filter("rn = 1").collect()}
    got = {(r.k, r.id) for r in latest_by(df, ["k"], [F.col("d")], [F.col("id")]).collect()}
    assert got == ref
    w2 = Window.partitionBy("k").orderBy(F.col("d").asc_nulls_last(), F.col("id").asc())
    ref2 = {(r.k, r.id) for r in df.withColumn("rn", F.row_number().over(w2)).filter("rn = 1").collect()}
    got2 = {(r.k, r.id) for r in earliest_by(df, ["k"], [F.col("d")], [F.col("id")]).collect()}
    assert got2 == ref2


@pytest.mark.parametrize("direction", ["next", "prev"])
def test_neighbour_matches_lead(spark, direction):
    df = spark.createDataFrame(_rows(3000, 25, 2, null_every=97, hot=7), "id long, k long, d date").filter(
        F.col("d").isNotNull())
    w = Window.partitionBy("k").orderBy("d", "id")
    fn = F.lead if direction == "next" else F.lag
    ref = df.withColumn("nb", F.when(F.col("k").isNotNull(), fn("d").over(w)))
    got = neighbour_in_order(df, "k", "d", "id", "d", "nb", direction=direction)
    assert sorted(ref.select("id", "nb").collect()) == sorted(got.select("id", "nb").collect())
    assert got.count() == df.count()


def test_first_k_pivot(spark):
    df = spark.createDataFrame([(1, 1, date(2024, 1, i)) for i in range(1, 8)] + [(2, 9, date(2024, 1, 1))],
                               "u long, id long, d date")
    r = {x.u: x for x in first_k_pivot(df, "u", [F.col("d"), F.col("id")], {"_d": "d"}, k=5,
                                       names=["a", "b", "c", "e", "f"]).collect()}
    assert r[1].a_d == date(2024, 1, 1) and r[1].f_d == date(2024, 1, 5)
    assert r[2].a_d == date(2024, 1, 1) and r[2].b_d is None


def test_semi_anti_and_group_membership(spark):
    members = spark.createDataFrame([(i,) for i in range(1, 8)], "user_id long")
    groups = spark.createDataFrame([(1, [2, 3], None), (4, None, [5]), (None, None, None)],
                                   "admin long, users array<long>, mentors array<long>")
    got = {r.user_id: r.g for r in membership_flag(members, groups, "user_id", ["admin"], ["users", "mentors"],
                                                   "g").collect()}
    assert got == {1: True, 2: True, 3: True, 4: True, 5: True, 6: False, 7: False}
    other = spark.createDataFrame([(6,), (6,)], "user_id long")
    assert {r.user_id for r in exclude(members, other, ["user_id"]).collect()} == {1, 2, 3, 4, 5, 7}
    flags = {r.user_id: r.f for r in exists_flag(members, other, ["user_id"], "f").collect()}
    assert flags[6] is True and flags[1] is False and len(flags) == 7


def test_answer_classify_unicode_and_two_classes(spark):
    rules = (AnswerRules("life", "актив", (("да", "true"), ("нет", "false"))),
             AnswerRules("goal", "цель", (("похудеть", "loss"),)))
    answers = spark.createDataFrame(
        [(1, 1, "Вы ведёте активный образ жизни?", "ДА, конечно", 1, None),
         (2, 1, "Вы ведёте активный образ жизни?", "Нет", 0, None),
         (3, 2, "Активность и цель?", "Хочу ПОХУДЕТЬ", 5, None)],
        "answer_id long, user_id long, question string, answer string, created_seq long, updated_seq long")
    r = {x.user_id: x for x in answer_classify(answers, rules).collect()}
    assert r[1].life == "true"                    # latest answer by created_seq; Cyrillic case folding
    assert r[2].life is None and r[2].goal == "loss"   # one question, two classes


def test_home_clusters_scores_and_confidence(spark):
    day, night = datetime(2024, 1, 1, 10, 0), datetime(2024, 1, 1, 17, 30)
    pts = []
    for i in range(40):
        pts.append(("u", 43.1000, 76.1000, night if i < 10 else day))
    for i in range(30):
        pts.append(("u", 43.2000, 76.2000, night if i < 5 else day))
    for i in range(30):
        pts.append(("u", 43.3000, 76.3000, day))
    df = spark.createDataFrame(pts, "user_id string, latitude double, longitude double, created_at timestamp_ntz")
    scores = sorted(r.score for r in home_clusters(df).collect())
    assert scores == [30, 40, 60]
    h = home_location(df).first()
    assert h.confidence == 40.0 and h.sample_size == 100 and h.night_occurrences == 10
    assert h.home_latitude == pytest.approx(43.1)


def test_geo_metrics_population_std_and_classes(spark):
    # facility at (0, 0); three points at 1, 2 and 4 km due north -> std_pop 1.25
    km = 1 / 111.19492664455873
    pts = [("a", k * km, 0.0, datetime(2024, 1, 1, 10)) for k in (1, 2, 4)] + [("b", 0.01, 0.0, None)]
    df = spark.createDataFrame(pts, "user_id string, latitude double, longitude double, created_at timestamp_ntz")
    mf = spark.createDataFrame([("a", "F"), ("b", "F"), ("c", "F"), ("d", "G")], "user_id string, facility_name string")
    coords = spark.createDataFrame([("F", 0.0, 0.0)], "facility_name string, fac_lat double, fac_lon double")
    r = {x.user_id: x for x in geo_metrics(df, mf, coords).collect()}
    assert r["a"].distance_variability == 1.25 and r["a"].avg_booking_distance_km == 2.33
    assert r["a"].location_data_quality == "poor"
    assert r["b"].location_data_quality == "insufficient" and r["b"].commute_convenience_score is None
    assert r["b"].distance_home_to_club_km is not None
    assert r["c"].location_data_quality == "no_user_data" and r["c"].location_sample_size == 0
    assert r["d"].location_data_quality == "no_club_coords" and r["d"].is_home_nearby is False


def test_ewma_matches_pandas(spark):
    import pandas as pd

    vals = [3, 1, 4, 1, 5, 9, 2, 6]
    df = spark.createDataFrame([(1, date(2024, 1, 1) + timedelta(weeks=i), v) for i, v in enumerate(vals)],
                               "user_id long, week date, sessions long")
    got = [r.sessions_ewma for r in ewma_norm(df, "sessions", 0.3).orderBy("week").collect()]
    ref = pd.Series(vals, dtype=float).ewm(alpha=0.3, adjust=True).mean().shift(1).tolist()
    assert got[0] is None
    assert all(abs(a - b) < 1e-12 for a, b in zip(got[1:], ref[1:]))


@pytest.mark.parametrize("rank_fn", ["row_number", "rank"])
def test_running_in_order_matches_window(spark, rank_fn):
    from renewlens.operators.ordered import running_in_order

    rows = [(i, k, d, (i * 7) % 11) for i, k, d in _rows(3000, 15, 3, null_every=101, hot=4) if d is not None]
    df = spark.createDataFrame(rows, "id long, k long, d date, x long")
    order = ["d"] if rank_fn == "rank" else ["d", "id"]
    w = Window.partitionBy("k").orderBy(*order)
    fn = F.row_number() if rank_fn == "row_number" else F.rank()
    ref = df.select("id", fn.over(w).alias("r"),
                    F.sum("x").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow)).alias("s"))
    got = running_in_order(df, "k", order, rank_col="r", sum_col="x", sum_out="s", rank_fn=rank_fn)
    assert sorted(ref.collect()) == sorted(got.select("id", "r", "s").collect())


def test_left_join_matches_plain_join(spark):
    from renewlens.operators.skew import left_join

    big = spark.createDataFrame([(i, None if i % 3 == 0 else i % 50) for i in range(5000)], "pid long, k long")
    small = spark.createDataFrame([(k, f"v{k}") for k in range(0, 50, 2)] + [(None, "none")], "k long, v string")
    ref = big.join(small, "k", "left").select("pid", "v").collect()
    assert sorted(map(str, ref)) == sorted(map(str, left_join(big, small, "k", ["pid"]).select("pid", "v").collect()))


@pytest.mark.parametrize("block", [None, 1, 3])
def test_ewma_blocks_match_pandas(spark, block):
    import pandas as pd

    vals = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5]
    df = spark.createDataFrame([(u, date(2024, 1, 1) + timedelta(weeks=i), v * u) for u in (1, 2)
                                for i, v in enumerate(vals)], "user_id long, week date, sessions long")
    got = ewma_norm(df, "sessions", 0.3, block=block).filter("user_id = 2").orderBy("week").collect()
    ref = pd.Series([v * 2 for v in vals], dtype=float).ewm(alpha=0.3, adjust=True).mean().shift(1).tolist()
    assert got[0].sessions_ewma is None
    assert all(abs(r.sessions_ewma - b) < 1e-9 for r, b in zip(got[1:], ref[1:]))


def test_exact_quantiles_nearest_rank(spark):
    import math as _m

    from renewlens.operators.quality import exact_quantiles

    rows = [("a", float(v)) for v in [5, 1, 3, 3, 9, 7, 2, 8, 6, 4, 10]] + [("b", float(v)) for v in range(100)]
    rows += [("b", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {(r.g, r.q): r.value for r in exact_quantiles(df, "g", "x", [0.25, 0.5, 0.75, 1.0], 5).collect()}
    for g in ("a", "b"):
        vals = sorted(x for gg, x in rows if gg == g and x is not None)
        for q in (0.25, 0.5, 0.75, 1.0):
            assert got[(g, q)] == vals[max(_m.ceil(q * len(vals)), 1) - 1]


def test_exact_quantiles_linear_matches_percentile(spark):
    from renewlens.operators.quality import exact_quantiles

    rows = [("a", float((i * 37) % 101) / 7) for i in range(203)] + [("b", 1.0), ("b", 4.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {(r.g, r.q): r.value for r in exact_quantiles(df, "g", "x", [0.25, 0.5, 0.9], 6, method="linear").collect()}
    ref = {(r.g, q): v for r in df.groupBy("g").agg(F.percentile("x", [0.25, 0.5, 0.9]).alias("p")).collect()
           for q, v in zip((0.25, 0.5, 0.9), r.p)}
    assert set(got) == set(ref)
    assert all(abs(got[k] - ref[k]) < 1e-12 for k in ref)


@pytest.fixture
def no_coalesce(spark):
    keys = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    spark.conf.set(keys[0], "false")
    spark.conf.set(keys[1], "-1")
    spark.conf.set(keys[2], "-1")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_key_is_spread_over_partitions(spark, no_coalesce):
    from renewlens.operators.skew import left_join

    n = 6000
    big = spark.createDataFrame([(i, None if i % 3 == 0 else i % 400) for i in range(n)], "pid long, k long")
    small = spark.createDataFrame([(k, k * 10) for k in range(400)], "k long, v long")
    j = left_join(big, small, "k", ["pid"]).withColumn("_p", F.spark_partition_id())
    sizes = [r["count"] for r in j.groupBy("_p").count().collect()]
    assert sum(sizes) == n and max(sizes) <= 2 * n / len(sizes), sizes  # a plain join puts all 2000 null keys in one task

    # segmented lead: the hot member's rows are windowed in (member, date) segments
    d = spark.createDataFrame([(i, 7 if i % 3 == 0 else i % 400, date(2024, 1, 1) + timedelta(days=i % 90))
                               for i in range(n)], "id long, k long, d date")
    out = neighbour_in_order(d, "k", "d", "id", "d", "nb").withColumn("_p", F.spark_partition_id())
    assert out.filter("k = 7").select("_p").distinct().count() > 4


def test_exact_quantiles_hot_value(spark):
    from renewlens.operators.quality import exact_quantiles

    vals = [0.0] * 700 + [float(i) for i in range(1, 1301)]
    df = spark.createDataFrame([("g", x) for x in vals], "g string, x double")
    got = {r.q: r.value for r in exact_quantiles(df, "g", "x", [0.25, 0.35, 0.5, 0.99], 8).collect()}
    s = sorted(vals)
    import math as _m
    assert got == {q: s[max(_m.ceil(q * len(s)), 1) - 1] for q in (0.25, 0.35, 0.5, 0.99)}
    lin = {r.q: r.value for r in exact_quantiles(df, "g", "x", [0.5], 8, method="linear").collect()}
    ref = df.agg(F.percentile("x", 0.5)).first()[0]
    assert abs(lin[0.5] - ref) < 1e-12


def test_exact_quantiles_without_exchange_reuse(spark):
    from renewlens.operators.quality import exact_quantiles

    df = spark.range(20_000).select(F.lit("g").alias("g"), (F.hash("id") / 7.0).alias("x"))
    want = df.agg(F.percentile("x", F.array(F.lit(0.25), F.lit(0.5)))).first()[0]
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            got = {r.q: r.value for r in exact_quantiles(df, "g", "x", [0.25, 0.5], 8, method="linear").collect()}
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")
        assert [got[0.25], got[0.5]] == pytest.approx(want, abs=1e-6)


def test_ewma_with_all_weight_on_the_last_week(spark):
    from renewlens.operators.weekly import ewma_norm

    df = spark.createDataFrame([(1, date(2024, 1, 1) + timedelta(weeks=i), v) for i, v in enumerate([3, 5, 7])], "user_id long, week date, sessions long")
    assert [r.sessions_ewma for r in ewma_norm(df, "sessions", 1.0).orderBy("week").collect()] == [None, 3.0, 5.0]


def test_points_with_nan_coordinates_are_dropped(spark):
    from renewlens.operators.location import flatten_location

    df = spark.createDataFrame([(1, (1.0, 2.0), None), (2, (float("nan"), 2.0), None), (3, (1.0, None), None)],
                               "user_id long, location struct<latitude:double,longitude:double>, created_at timestamp_ntz")
    assert [r.user_id for r in flatten_location(df).collect()] == ["1"]


def test_repeated_dimension_rows_do_not_fan_out(spark):
    from renewlens.plans.profile import asked_answers, facility_fallback

    members = spark.createDataFrame([(1, 7), (2, 8)], "user_id int, facility_id int")
    names = spark.createDataFrame([(7, "b"), (7, "a")], "facility_id int, name string")
    other = spark.createDataFrame([(8, "c"), (8, "c")], "facility_id int, name string")
    got = facility_fallback(members, names, other, "facility_id", "club").select("user_id", "club").collect()
    assert sorted(map(tuple, got)) == [(1, "a"), (2, "c")]
    asked = spark.createDataFrame([(1, "q"), (1, "q")], "question_id int, question string")
    answers = spark.createDataFrame([(5, 1), (6, 9)], "answer_id int, question_id int")
    assert [r.answer_id for r in asked_answers(answers, asked).collect()] == [5]


def test_drift_on_deciles(spark):
    from renewlens.operators.quality import psi

    same = spark.range(1000).select((F.col("id") / 2).cast("long").cast("double").alias("x"), (F.col("id") % 2 == 0).alias("b"))
    assert abs(psi(same, "x", F.col("b")).first().psi) < 1e-12
    moved = spark.range(1000).select(F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(5000.0).cast("double").alias("x"), (F.col("id") % 2 == 0).alias("b"))
    assert psi(moved, "x", F.col("b")).first().psi > 5
    none = spark.createDataFrame([(1.0, False), (None, True)], "x double, b boolean")
    got = psi(none, "x", F.col("b")).first()
    assert got.current_rows == 1 and got.psi is None


def test_completion_per_period_ties_and_gaps(spark):
    from renewlens.plans.periods import completion_per_period

    mart = spark.sql("""select * from values (1, 9, date'2024-01-01', date'2024-02-01'), (2, 9, date'2024-02-01', date'2024-02-01'),
                        (3, 9, date'2024-02-01', null), (4, null, date'2024-01-01', null) as t(period_id, user_id, start_date, next_start)""")
    seen = spark.sql("""select * from values (9, timestamp'2024-01-31 23:00:00', 'purchase'), (9, timestamp'2024-02-01 00:00:00', 'view'),
                        (9, timestamp'2024-02-02 00:00:00', 'purchase'), (9, timestamp'2023-01-01 00:00:00', 'view'),
                        (null, timestamp'2024-02-02 00:00:00', 'purchase') as t(user_id, ts, event_type)""")
    got = {r.period_id: (r.booked, r.completed, r.completion_rate) for r in completion_per_period(seen, mart).collect()}
    assert got == {1: (1, 1, 1.0), 2: (None, None, None), 3: (2, 1, 0.5), 4: (None, None, None)}


def test_scores_of_a_date_are_replaced(spark):
    import uuid
    from renewlens.operators.scoring import write_scores
    from renewlens.session import scratch_path

    path = scratch_path(spark, "scores", uuid.uuid4().hex)
    frame = lambda v, d: spark.sql(f"select 1 as period_id, {v} as probability, date'{d}' as score_date")
    for v, d in ((0.1, "2024-01-01"), (0.2, "2024-01-02"), (0.3, "2024-01-02")):
        write_scores(frame(v, d), path)
    assert sorted(float(r.probability) for r in spark.read.parquet(path).collect()) == [0.1, 0.3]
