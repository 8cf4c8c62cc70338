"""Cox proportional hazards with an L2 penalty, fitted by Newton steps over distributed risk-set sums.

Rows of one duration are added up first (a partial aggregate).  The sums over all who are still at risk at a duration
are suffix sums over the ordered durations: inside a range of durations by a window, from later ranges by a table
of one row per range.  A Newton step brings a vector and a matrix of the number of features to the driver, nothing that
grows with the rows.  Ties are handled by Breslow's approximation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renewlens.sources.sinks import store

#: Ranges of durations; their totals are one small table.
RANGES = 64


@dataclass
class CoxModel:
    """``beta`` is per standard deviation of a feature, ``coefficients`` per unit; ``gradient`` belongs to ``beta`` and is
    that of the penalised mean log likelihood."""

    features: list[str]
    mean: np.ndarray
    std: np.ndarray
    beta: np.ndarray
    gradient: np.ndarray
    log_likelihood: float
    rows: int
    events: int

    @property
    def coefficients(self) -> np.ndarray:
        return self.beta / self.std

    def log_risk(self) -> Column:
        """Log of a row's hazard relative to a row with mean features."""
        terms = [(F.col(f).cast("double") - float(m)) * float(c) for f, m, c in zip(self.features, self.mean, self.coefficients)]
        return sum(terms[1:], terms[0])


def prepared(df: DataFrame, features: Sequence[str], duration: str, event: str) -> DataFrame:
    """_t, _d and one double per feature; rows with a null among them are left out."""
    cols = [F.col(duration).cast("double").alias("_t"), F.col(event).cast("int").alias("_d")]
    cols += [F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)]
    return df.select(*cols).na.drop()


def _ranges(rows: DataFrame) -> list[float]:
    """At most RANGES - 1 durations that part the distinct durations evenly."""
    cuts = rows.select("_t").distinct().agg(F.percentile_approx("_t", [i / RANGES for i in range(1, RANGES)], 1000)).first()[0]
    return sorted(set(cuts or []))


def _suffix(per: DataFrame, names: Sequence[str], cuts: Sequence[float]) -> DataFrame:
    """``per`` (one row a duration) with the sums of ``names`` over this and all longer durations."""
    bounds = F.array(*(F.lit(c) for c in cuts)) if cuts else F.array().cast("array<double>")
    placed = per.withColumn("_b", bounds).withColumn("_range", F.size(F.filter("_b", lambda c: c <= F.col("_t")))).drop("_b")
    inside = Window.partitionBy("_range").orderBy(F.col("_t").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = placed.groupBy("_range").agg(*(F.sum(n).alias(n) for n in names))
    later = Window.orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)    # over RANGES rows
    totals = totals.select("_range", *(F.coalesce(F.sum(n).over(later), F.lit(0.0)).alias(f"_later_{n}") for n in names))
    both = placed.withColumns({f"_in_{n}": F.sum(n).over(inside) for n in names}).join(F.broadcast(totals), "_range")
    return both.withColumns({f"{n}_at": F.col(f"_in_{n}") + F.col(f"_later_{n}") for n in names}).drop(
        "_range", *(f"_in_{n}" for n in names), *(f"_later_{n}" for n in names))


def _pairs(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k) for j in range(i, k)]


def risk_sums(rows: DataFrame, z: Sequence[Column], beta: Sequence[float], cuts: Sequence[float]) -> DataFrame:
    """One row a duration: events, their sums, and s0_at, s1_.._at, s2_.._at over all still at risk."""
    k = len(z)
    eta = sum((z[i] * float(beta[i]) for i in range(1, k)), z[0] * float(beta[0]))
    r = F.exp(eta)
    aggs = {"d": F.sum(F.col("_d").cast("double")), "ee": F.sum(F.col("_d") * eta), "n": F.count("*").cast("double"), "s0": F.sum(r)}
    aggs |= {f"e{i}": F.sum(F.col("_d") * z[i]) for i in range(k)} | {f"s1_{i}": F.sum(r * z[i]) for i in range(k)}
    aggs |= {f"s2_{i}_{j}": F.sum(r * z[i] * z[j]) for i, j in _pairs(k)}
    per = rows.groupBy("_t").agg(*(c.alias(n) for n, c in aggs.items()))
    return _suffix(per, ["n", "s0", *(f"s1_{i}" for i in range(k)), *(f"s2_{i}_{j}" for i, j in _pairs(k))], cuts)


def derivatives(sums: DataFrame, k: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Log likelihood, gradient and negative second derivatives out of ``risk_sums``; one row reaches the driver."""
    s0, d = F.col("s0_at"), F.col("d")
    mean = [F.col(f"s1_{i}_at") / s0 for i in range(k)]
    row = sums.filter("d > 0").agg(
        F.coalesce(F.sum(F.col("ee") - d * F.log(s0)), F.lit(0.0)).alias("ll"), *(F.coalesce(F.sum(F.col(f"e{i}") - d * mean[i]), F.lit(0.0)).alias(f"g{i}") for i in range(k)),
        *(F.coalesce(F.sum(d * (F.col(f"s2_{i}_{j}_at") / s0 - mean[i] * mean[j])), F.lit(0.0)).alias(f"h{i}_{j}") for i, j in _pairs(k))).first()
    h = np.zeros((k, k))
    for i, j in _pairs(k):
        h[i, j] = h[j, i] = row[f"h{i}_{j}"]
    return row["ll"], np.array([row[f"g{i}"] for i in range(k)]), h


def fit_cox(df: DataFrame, features: Sequence[str], duration: str, event: str, penalty: float = 0.1, tol: float = 1e-10,
            max_iter: int = 30) -> CoxModel:
    """Maximise mean log partial likelihood minus ``penalty`` / 2 times the squared ``beta`` (features standardised).

    Rows with a null duration, event or feature are left out; a feature that doesn't vary gets 0; without rows or
    events all coefficients are 0.  A step that doesn't raise the objective is halved.
    """
    k = len(features)
    rows = store(prepared(df, features, duration, event), "cox")
    names = [f"_x{i}" for i in range(k)]
    s = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("_d"), F.lit(0)).alias("d"), *(F.avg(c).alias(f"m{c}") for c in names),
                 *(F.stddev_pop(c).alias(f"s{c}") for c in names)).first()
    n = s["n"]
    mean = np.array([s[f"m{c}"] or 0.0 for c in names])
    std = np.array([s[f"s{c}"] or 0.0 for c in names])
    std = np.where(std > 1e-12 * np.maximum(np.abs(mean), 1.0), std, 1.0)
    if not n or not s["d"]:
        return CoxModel(list(features), mean, std, np.zeros(k), np.zeros(k), 0.0, n, s["d"])
    z = [(F.col(c) - float(m)) / float(v) for c, m, v in zip(names, mean, std)]
    cuts = _ranges(rows)

    def at(beta):
        ll, g, h = derivatives(risk_sums(rows, z, beta, cuts), k)
        return ll / n - penalty / 2 * beta @ beta, g / n - penalty * beta, h / n + penalty * np.eye(k), ll

    beta = np.zeros(k)
    value, gradient, curve, ll = at(beta)
    for _ in range(max_iter):
        if np.abs(gradient).max() <= tol:
            break
        step = np.linalg.lstsq(curve, gradient, rcond=None)[0]
        for _ in range(20):
            new = at(beta + step)
            if np.isfinite(new[0]) and new[0] >= value - 1e-15 * abs(value):
                break
            step = step / 2
        else:
            break
        beta, (value, gradient, curve, ll) = beta + step, new
    return CoxModel(list(features), mean, std, beta, gradient, ll, n, s["d"])


def baseline_hazard(df: DataFrame, model: CoxModel, duration: str, event: str) -> DataFrame:
    """duration, at_risk, events and the hazard (Breslow) of a row with mean features, per duration with events."""
    rows = prepared(df, model.features, duration, event)
    z = [(F.col(f"_x{i}") - float(m)) / float(v) for i, (m, v) in enumerate(zip(model.mean, model.std))]
    sums = risk_sums(rows, z, model.beta, _ranges(rows)).filter("d > 0")
    return sums.select(F.col("_t").alias("duration"), F.col("n_at").cast("long").alias("at_risk"), F.col("d").cast("long").alias("events"),
                       (F.col("d") / F.col("s0_at")).alias("hazard"))
