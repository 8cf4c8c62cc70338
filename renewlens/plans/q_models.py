"""Models whose fit SQL can repeat: Newton steps over sums, written out step by step."""

from __future__ import annotations

from pyspark.sql import functions as F

from renewlens import config
from renewlens.operators import cox
from renewlens.plans import periods as P
from renewlens.plans.catalog import register
from renewlens.plans.q_periods import MART_WITH, mart

COX_FEATURES = ["start_month", "length_days", "freeze_days"]
COX_PENALTY = 0.1


def _det(m):
    a, b, c = m
    return (f"({a[0]}*({b[1]}*{c[2]}-{b[2]}*{c[1]}) - {a[1]}*({b[0]}*{c[2]}-{b[2]}*{c[0]}) + {a[2]}*({b[0]}*{c[1]}-{b[1]}*{c[0]}))")


def _cox_sql(steps: int = 9) -> str:
    """Newton steps for three standardised features, each a few common table expressions, solved by Cramer's rule."""
    z, pairs = ("za", "zb", "zc"), [(i, j) for i in range(3) for j in range(i, 3)]
    name = lambda i, j: f"h{min(i, j)}{max(i, j)}"
    sql = MART_WITH + f"""
, spell AS MATERIALIZED (
  SELECT CAST(floor((least(end_corrected, DATE '{config.PERIOD_AS_OF}') - start_date) / 7) AS INTEGER) + 1 AS t,
         CAST(end_corrected + 30 <= DATE '{config.PERIOD_AS_OF}'
           AND NOT COALESCE(next_start <= least(end_corrected + 30, DATE '{config.PERIOD_AS_OF}'), false) AS INTEGER) AS d,
         CAST(month(start_date) AS DOUBLE) AS a, CAST(length_days AS DOUBLE) AS b, CAST(freeze_days AS DOUBLE) AS c
  FROM mart WHERE start_date <= DATE '{config.PERIOD_AS_OF}'),
scale AS MATERIALIZED (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, stddev_pop(b) AS sb, avg(c) AS mc, stddev_pop(c) AS sc,
                              CAST(count(*) AS DOUBLE) AS n, sum(d) AS events FROM spell),
unit AS MATERIALIZED (SELECT t, d, (a - ma) / sa AS za, (b - mb) / sb AS zb, (c - mc) / sc AS zc FROM spell, scale),
b0 AS MATERIALIZED (SELECT 0.0::DOUBLE AS p0, 0.0::DOUBLE AS p1, 0.0::DOUBLE AS p2)"""
    for k in range(steps + 1):
        at = ", ".join([f"sum(w) AS s, sum(w * {z[0]}) AS s0, sum(w * {z[1]}) AS s1, sum(w * {z[2]}) AS s2"]
                       + [f"sum(w * {z[i]} * {z[j]}) AS s{i}{j}" for i, j in pairs])
        over = ", ".join(f"sum({c}) OVER (ORDER BY t DESC) AS {c}" for c in ["s", "s0", "s1", "s2", *(f"s{i}{j}" for i, j in pairs)])
        grad = ", ".join(f"(sum(e{i}) - sum(d * s{i} / s)) / any_value(n) - {COX_PENALTY} * any_value(p{i}) AS g{i}" for i in range(3))
        hess = ", ".join(f"sum(d * (s{i}{j} / s - s{i} * s{j} / s / s)) / any_value(n)" + (f" + {COX_PENALTY}" if i == j else "") + f" AS h{i}{j}" for i, j in pairs)
        sql += f"""
, t{k} AS MATERIALIZED (SELECT t, sum(d) AS d, sum(d * za) AS e0, sum(d * zb) AS e1, sum(d * zc) AS e2, {at}
                        FROM (SELECT unit.*, exp(p0 * za + p1 * zb + p2 * zc) AS w FROM unit, b{k}) GROUP BY t)
, r{k} AS MATERIALIZED (SELECT t, d, e0, e1, e2, {over} FROM t{k})
, g{k} AS MATERIALIZED (SELECT {grad}, {hess} FROM r{k}, scale, b{k})"""
        if k < steps:
            m = [[name(i, j) for j in range(3)] for i in range(3)]
            solved = [f"p{c} + {_det([[f'g{i}' if j == c else m[i][j] for j in range(3)] for i in range(3)])} / {_det(m)} AS p{c}" for c in range(3)]
            sql += f"""
, b{k + 1} AS MATERIALIZED (SELECT {', '.join(solved)} FROM b{k}, g{k})"""
    return sql


_LAST = 9
COX_SQL = _cox_sql(_LAST)


def _spells(t):
    return P.spells(mart(t), config.PERIOD_AS_OF, covariates=["length_days", "freeze_days"])


@register("train_cox", COX_SQL + f"""
SELECT 'start_month' AS feature, round(p0 / sa, 7) AS coefficient, round(p0, 6) AS per_deviation, 0.0::DOUBLE AS gradient, CAST(n AS BIGINT) AS rows,
       CAST(events AS BIGINT) AS events FROM b{_LAST}, scale
UNION ALL SELECT 'length_days', round(p1 / sb, 7), round(p1, 6), 0.0, CAST(n AS BIGINT), CAST(events AS BIGINT) FROM b{_LAST}, scale
UNION ALL SELECT 'freeze_days', round(p2 / sc, 7), round(p2, 6), 0.0, CAST(n AS BIGINT), CAST(events AS BIGINT) FROM b{_LAST}, scale""")
def train_cox(t):
    """Cox proportional hazards (L2 0.1, Breslow ties) on weeks held: coefficients, and the gradient there (zero)."""
    m = cox.fit_cox(_spells(t), COX_FEATURES, "weeks", "churned", COX_PENALTY)
    rows = [(f, round(float(c), 7), round(float(b), 6), abs(round(float(g), 8)), m.rows, m.events) for f, c, b, g in zip(m.features, m.coefficients, m.beta, m.gradient)]
    return t.spark.createDataFrame(rows, "feature string, coefficient double, per_deviation double, gradient double, rows long, events long")


@register("cox_baseline_hazard", COX_SQL + f"""
SELECT CAST(r.t AS DOUBLE) AS duration, (SELECT count(*) FROM spell s WHERE s.t >= r.t) AS at_risk, CAST(r.d AS BIGINT) AS events,
       round(r.d / r.s, 7) AS hazard FROM r{_LAST} r WHERE r.d > 0""")
def cox_baseline_hazard(t):
    """Breslow hazard per week held of a period with mean features."""
    s = _spells(t)
    m = cox.fit_cox(s, COX_FEATURES, "weeks", "churned", COX_PENALTY)
    return cox.baseline_hazard(s, m, "weeks", "churned").withColumn("hazard", F.round("hazard", 7))
