import math
import random

import numpy as np
from pyspark.sql import functions as F

from renewlens.operators import cox


def brute(rows, beta):
    """Log likelihood, gradient and curvature row by row (Breslow)."""
    k = len(beta)
    ll, g, h = 0.0, np.zeros(k), np.zeros((k, k))
    for t, d, x in rows:
        if not d:
            continue
        risk = [(math.exp(np.dot(beta, y)), np.array(y)) for u, _, y in rows if u >= t]
        s0 = sum(w for w, _ in risk)
        s1 = sum(w * y for w, y in risk)
        s2 = sum(w * np.outer(y, y) for w, y in risk)
        ll += np.dot(beta, x) - math.log(s0)
        g += np.array(x) - s1 / s0
        h += s2 / s0 - np.outer(s1, s1) / s0**2
    return ll, g, h


def made(seed, n=150, k=3):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        x = [rng.gauss(0, 1) * (i + 1) for i in range(k)]
        t = rng.expovariate(math.exp(0.5 * x[0] - 0.2 * x[1]))
        out.append((float(math.ceil(min(t, 3.0) * 20)), t < 3.0 and rng.random() < 0.8, x))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(t, bool(d), *x) for t, d, x in rows], "t double, d boolean, " + ", ".join(f"x{i} double" for i in range(len(rows[0][2]))))


def test_sums_against_risk_sets_row_by_row(spark):
    rows = made(1)
    df = cox.prepared(frame(spark, rows), ["x0", "x1", "x2"], "t", "d")
    for beta in ([0.0, 0.0, 0.0], [0.4, -0.3, 0.1]):
        for cuts in ([], [5.0, 6.0, 30.0]):
            ll, g, h = cox.derivatives(cox.risk_sums(df, [F.col(f"_x{i}") for i in range(3)], beta, cuts), 3)
            a, b, c = brute(rows, np.array(beta))
            assert abs(ll - a) < 1e-9 and np.allclose(g, b, atol=1e-9) and np.allclose(h, c, atol=1e-9)


def test_fit_is_the_optimum_and_finds_the_effect(spark):
    rows = made(2, 400)
    m = cox.fit_cox(frame(spark, rows), ["x0", "x1", "x2"], "t", "d", penalty=0.1)
    z = [(t, d, list((np.array(x) - m.mean) / m.std)) for t, d, x in rows]
    _, g, _ = brute(z, m.beta)
    assert np.abs(g / len(rows) - 0.1 * m.beta).max() < 1e-9 and np.abs(m.gradient).max() < 1e-9
    free = cox.fit_cox(frame(spark, rows), ["x0", "x1", "x2"], "t", "d", penalty=0.0)
    assert 0.3 < free.coefficients[0] < 0.7 and -0.35 < free.coefficients[1] < -0.05 and abs(free.coefficients[2]) < 0.1
    assert abs(m.beta[0]) < abs(free.beta[0])
    hazard = cox.baseline_hazard(frame(spark, rows), free, "t", "d").collect()
    assert sum(r.events for r in hazard) == sum(d for _, d, _ in rows)
    first = min(hazard, key=lambda r: r.duration)
    assert first.at_risk == sum(t >= first.duration for t, _, _ in rows)


def test_null_constant_and_empty_input(spark):
    rows = made(3, 60)
    df = frame(spark, rows).withColumn("same", F.lit(5.0))
    bad = spark.createDataFrame([(None, True, 1.0, 1.0, 1.0, 5.0), (1.0, None, 1.0, 1.0, 1.0, 5.0), (1.0, True, None, 1.0, 1.0, 5.0)], df.schema)
    a = cox.fit_cox(df, ["x0", "same"], "t", "d")
    b = cox.fit_cox(df.unionByName(bad), ["x0", "same"], "t", "d")
    assert np.allclose(a.beta, b.beta, atol=1e-12) and a.rows == b.rows == 60 and a.beta[1] == 0
    assert cox.fit_cox(df.limit(0), ["x0"], "t", "d").beta.tolist() == [0.0]
    assert cox.fit_cox(df.withColumn("d", F.lit(False)), ["x0"], "t", "d").events == 0
