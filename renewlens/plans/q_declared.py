"""Declared retention marts: weekly facts, norms, deltas, data quality, drift,
calibration, risk bands and model training / scoring."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import functions as F

from renewlens import config
from renewlens.operators import quality as Q
from renewlens.operators import scoring as S
from renewlens.operators import weekly as W
from renewlens.plans import periods as P
from renewlens.plans.catalog import register
from renewlens.session import scratch_path
from renewlens.plans.oracle import with_adapters
from renewlens.plans.q_periods import MART_WITH, mart
from renewlens.sources.snapshots import version

ALPHA = 0.3      # EWMA smoothing (a parameter; the docs name EWMA without a value)
AS_OF = config.ACTIVITY_AS_OF

FACT_CTES = """
facts AS (
  SELECT user_id, CAST(date_trunc('week', ts) AS DATE) AS week, count(*) AS sessions,
         sum(CAST(event_type = 'purchase' AS BIGINT)) AS completed,
         sum(CAST(event_type IN ('purchase', 'view') AS BIGINT)) AS booked,
         sum(CAST(event_type = 'error' AS BIGINT)) AS cancelled,
         count(*) FILTER (event_type = 'purchase' AND minute(ts) >= 15) AS late,
         sum(hour(ts)) AS hour_sum, round(sum(value), 6) AS value_sum
  FROM activity GROUP BY 1, 2),
spine AS (
  SELECT user_id, CAST(unnest(generate_series(w0, w1, INTERVAL 7 DAY)) AS DATE) AS week
  FROM (SELECT user_id, min(week) AS w0, max(week) AS w1 FROM facts GROUP BY user_id)),
fw AS (
  SELECT s.user_id, s.week, COALESCE(f.sessions, 0) AS sessions, COALESCE(f.completed, 0) AS completed,
         COALESCE(f.booked, 0) AS booked, COALESCE(f.cancelled, 0) AS cancelled, COALESCE(f.late, 0) AS late,
         COALESCE(f.hour_sum, 0) AS hour_sum, COALESCE(f.value_sum, 0.0) AS value_sum
  FROM spine s LEFT JOIN facts f ON f.user_id = s.user_id AND f.week = s.week)"""
FACT_WITH = with_adapters("activity", extra=FACT_CTES)
PREV = "OVER (PARTITION BY user_id ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def facts(t):
    return W.fact_member_week(t.adapters.activity)


@register("fact_member_week", FACT_WITH + "SELECT * FROM fw")
def fact_member_week(t):
    """Weekly counts per member including silent weeks between first and last activity."""
    return facts(t)


EWMA_CTES = FACT_WITH + f"""
, idx AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY week) - 1 AS i FROM fw),
e AS (SELECT user_id, week, sessions,
             sum(pow({1 - ALPHA}, -i) * sessions) {PREV} / sum(pow({1 - ALPHA}, -i)) {PREV} AS ewma
      FROM idx)
"""


@register("ewma_norm", EWMA_CTES + "SELECT user_id, week, sessions, round(ewma, 6) AS sessions_ewma FROM e")
def ewma_norm(t):
    """Personal norm: EWMA of the member's previous weeks (alpha 0.3), null in the first week."""
    e = W.ewma_norm(facts(t), "sessions", ALPHA)
    return e.select("user_id", "week", "sessions", F.round("sessions_ewma", 6).alias("sessions_ewma"))


@register("norm_delta", EWMA_CTES + "SELECT user_id, week, sessions, round(sessions - ewma, 6) AS sessions_delta FROM e")
def norm_delta(t):
    """actual - EWMA norm of previous weeks; a drop below the norm is negative."""
    d = W.norm_delta(facts(t), "sessions", ALPHA)
    return d.select("user_id", "week", "sessions", F.round("sessions_delta", 6).alias("sessions_delta"))


@register("quantile_norm", FACT_WITH + """
SELECT user_id, quantile_cont(sessions, 0.25) AS sessions_p25, quantile_cont(sessions, 0.5) AS sessions_p50,
       quantile_cont(sessions, 0.75) AS sessions_p75
FROM fw GROUP BY user_id""")
def quantile_norm(t):
    """25/50/75th percentile of each member's weekly sessions."""
    return W.quantile_norm(facts(t), "sessions")


@register("completion_rate", FACT_WITH + """
SELECT user_id, week, CASE WHEN booked > 0 THEN round(completed / booked, 9) END AS completion_rate FROM fw""")
def completion_rate(t):
    """Completed / booked sessions per member-week (null when nothing was booked)."""
    c = W.completion_rate(facts(t))
    return c.select("user_id", "week", F.round("completion_rate", 9).alias("completion_rate"))


@register("completion_per_period", MART_WITH + """,
activity AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type FROM events),
owned AS (
  SELECT a.event_type, (SELECT arg_max(m.period_id, (m.start_date, m.period_id)) FROM mart m
                        WHERE m.user_id = a.user_id AND m.start_date <= a.day) AS period_id
  FROM activity a WHERE a.event_type IN ('purchase', 'view')),
n AS (SELECT period_id, count(*) AS booked, count(*) FILTER (event_type = 'purchase') AS completed FROM owned GROUP BY ALL)
SELECT m.period_id, m.user_id, n.booked, n.completed, round(n.completed / n.booked, 9) AS completion_rate
FROM mart m LEFT JOIN n USING (period_id)""")
def completion_per_period(t):
    """Completed / booked sessions of each membership period."""
    c = P.completion_per_period(t.adapters.activity, mart(t))
    return c.withColumn("completion_rate", F.round("completion_rate", 9))


@register("rate_deltas", FACT_WITH + f"""
, r AS (SELECT *, CASE WHEN sessions > 0 THEN cancelled / sessions END AS cancel_rate,
               CASE WHEN booked > 0 THEN completed / booked END AS completion_rate,
               CASE WHEN booked > 0 THEN (booked - completed) / booked END AS miss_rate,
               CASE WHEN completed > 0 THEN late / completed END AS late_rate FROM fw)
SELECT user_id, week, round(cancel_rate - avg(cancel_rate) {PREV}, 9) AS cancel_rate_delta,
       round(completion_rate - avg(completion_rate) {PREV}, 9) AS completion_rate_delta,
       round(miss_rate - avg(miss_rate) {PREV}, 9) AS miss_rate_delta,
       round(late_rate - avg(late_rate) {PREV}, 9) AS late_rate_delta
FROM r""")
def rate_deltas(t):
    """Cancellation / completion / miss rate this week vs the member's mean of previous weeks."""
    r = W.rate_deltas(facts(t))
    return r.select("user_id", "week", *[F.round(f"{c}_delta", 9).alias(f"{c}_delta")
                                         for c in ("cancel_rate", "completion_rate", "miss_rate", "late_rate")])


@register("usage_deltas", FACT_WITH + f"""
SELECT user_id, week, round(sessions - avg(sessions) {PREV}, 9) AS sessions_vs_norm,
       round(booked - avg(booked) {PREV}, 9) AS booked_vs_norm,
       round(value_sum - avg(value_sum) {PREV}, 6) AS value_sum_vs_norm
FROM fw""")
def usage_deltas(t):
    """Usage metrics per week vs the member's mean of previous weeks."""
    u = W.usage_deltas(facts(t))
    return u.select("user_id", "week", F.round("sessions_vs_norm", 9).alias("sessions_vs_norm"),
                    F.round("booked_vs_norm", 9).alias("booked_vs_norm"),
                    F.round("value_sum_vs_norm", 6).alias("value_sum_vs_norm"))


@register("booking_time_shift", FACT_WITH + f"""
, hours AS (SELECT user_id, CAST(date_trunc('week', ts) AS DATE) AS week, sum(sin(radians(15 * hour(ts)))) AS y,
                   sum(cos(radians(15 * hour(ts)))) AS x FROM activity GROUP BY ALL),
ways AS (SELECT fw.user_id, week, sessions, COALESCE(y, 0) AS y, COALESCE(x, 0) AS x, sum(sessions) {PREV} AS n0,
                sum(y) {PREV} AS y0, sum(x) {PREV} AS x0
         FROM fw LEFT JOIN hours USING (user_id, week)),
turned AS (SELECT user_id, week, CASE WHEN sessions > 0 AND sqrt(x * x + y * y) > 1e-9 * sessions
                                       AND sqrt(x0 * x0 + y0 * y0) > 1e-9 * n0
                                      THEN degrees(atan2(y, x) - atan2(y0, x0)) / 15 END AS d FROM ways)
SELECT user_id, week, CASE WHEN abs(abs(w) - 12) < 1e-7 THEN 12.0 ELSE round(w, 7) + 0.0 END AS hour_shift
FROM (SELECT *, CASE WHEN d > 12 THEN d - 24 WHEN d <= -12 THEN d + 24 ELSE d END AS w FROM turned)""")
def booking_time_shift(t):
    """Mean booking time this week minus the mean of all earlier activity, by directions on the clock."""
    b = W.booking_time_shift(W.fact_member_week(t.adapters.activity, extra=W.clock_sums(F.hour("ts"))))
    return b.select("user_id", "week", (F.round("hour_shift", 7) + 0.0).alias("hour_shift"))


@register("idle_gap_days", with_adapters("activity") + """
, a AS (SELECT *, CAST(ts AS DATE) AS day,
               lag(CAST(ts AS DATE)) OVER (PARTITION BY user_id ORDER BY ts, activity_id) AS prev_day FROM activity)
SELECT user_id, CAST(date_trunc('week', ts) AS DATE) AS week, max(day - prev_day) AS max_idle_gap_days,
       count(*) AS sessions
FROM a GROUP BY 1, 2""")
def idle_gap_days(t):
    """Longest gap (days since previous activity) per member-week; segmented lag, no hot task."""
    return W.idle_gap_days(t.adapters.activity)


@register("variety_counts", with_adapters("activity") + """
, a AS (SELECT *, CAST(date_trunc('week', ts) AS DATE) AS week, CAST(ts AS DATE) AS day FROM activity),
d AS (SELECT user_id, week, sum(CAST(n >= 2 AS BIGINT)) AS double_days FROM (
        SELECT user_id, week, day, count(*) AS n FROM a WHERE event_type = 'purchase' GROUP BY 1, 2, 3)
      GROUP BY 1, 2)
SELECT v.user_id, v.week, v.trainers, v.session_types, COALESCE(d.double_days, 0) AS double_days
FROM (SELECT user_id, week, count(DISTINCT trainer_id) AS trainers, count(DISTINCT event_type) AS session_types
      FROM a GROUP BY 1, 2) v
LEFT JOIN d ON d.user_id = v.user_id AND d.week = v.week""")
def variety_counts(t):
    """Distinct trainers and session types per week; days with two or more completed sessions."""
    return W.variety_counts(t.adapters.activity)


@register("progress_deltas", with_adapters("body_tests") + """
, r AS (SELECT user_id, weight, fat_pct, row_number() OVER (PARTITION BY user_id ORDER BY tested_at DESC, test_id DESC)
               AS rn FROM body_tests WHERE tested_at IS NOT NULL)
SELECT user_id, round(max(CASE WHEN rn = 1 THEN weight END) - max(CASE WHEN rn = 2 THEN weight END), 6)
         AS weight_delta,
       round(max(CASE WHEN rn = 1 THEN fat_pct END) - max(CASE WHEN rn = 2 THEN fat_pct END), 6) AS fat_pct_delta
FROM r WHERE rn <= 2 GROUP BY user_id""")
def progress_deltas(t):
    """Latest body measure minus the previous one (top-2 per member, pivoted)."""
    from renewlens.operators.ranking import first_k_pivot

    b = t.adapters.body_tests.filter(F.col("tested_at").isNotNull())
    p = first_k_pivot(b, "user_id", [F.col("tested_at").desc(), F.col("test_id").desc()],
                      {"weight": "weight", "fat_pct": "fat_pct"}, k=2, names=["last_", "prev_"])
    return p.select("user_id", F.round(F.col("last_weight") - F.col("prev_weight"), 6).alias("weight_delta"),
                    F.round(F.col("last_fat_pct") - F.col("prev_fat_pct"), 6).alias("fat_pct_delta"))


@register("measure_progress", with_adapters("measures") + """
SELECT user_id, kind, round(last[1] - last[2], 6) AS value_delta FROM (
  SELECT user_id, kind, list(value ORDER BY measured_at DESC, measure_id DESC) AS last
  FROM measures WHERE measured_at IS NOT NULL GROUP BY ALL)""")
def measure_progress(t):
    """Latest assessment and lifted weight minus the previous ones."""
    return W.measure_progress(t.adapters.measures).withColumn("value_delta", F.round("value_delta", 6))


RISK_SQL = ("CASE WHEN probability IS NULL THEN NULL WHEN probability < 0.3 THEN 'very_high' "
            "WHEN probability < 0.5 THEN 'high' WHEN probability < 0.7 THEN 'medium' "
            "WHEN probability < 0.85 THEN 'low' ELSE 'very_low' END")


@register("risk_band", with_adapters("scores") + f"SELECT user_id, probability, {RISK_SQL} AS risk_band FROM scores")
def risk_band(t):
    """Retention probability -> left-closed risk band."""
    s = t.adapters.scores
    return s.select("user_id", "probability", S.risk_band("probability").alias("risk_band"))


@register("intervention_level", with_adapters("scores") + """
SELECT user_id, CASE WHEN probability < 0.3 THEN 'critical' WHEN probability < 0.5 THEN 'warning'
                     WHEN probability < 0.7 THEN 'watch' ELSE 'none' END AS intervention_level
FROM scores""")
def intervention_level(t):
    """Retention probability -> critical / warning / watch / none."""
    s = t.adapters.scores
    return s.select("user_id", S.intervention_level("probability").alias("intervention_level"))


@register("band_summary", with_adapters("scores") + f"""
SELECT {RISK_SQL} AS risk_band, count(*) AS members, round(avg(probability), 9) AS mean_probability
FROM scores GROUP BY 1""")
def band_summary(t):
    """Members and mean probability per risk band."""
    b = S.band_summary(t.adapters.scores)
    return b.withColumn("mean_probability", F.round("mean_probability", 9))


@register("calibration_table", with_adapters("scores") + """
SELECT CAST(least(floor(probability * 10), 9) AS INTEGER) AS bin, count(*) AS n,
       round(avg(probability), 9) AS mean_predicted, round(avg(CAST(observed AS DOUBLE)), 9) AS observed_rate
FROM scores GROUP BY 1""")
def calibration_table(t):
    """Predicted vs observed rate per probability decile."""
    c = Q.calibration(t.adapters.scores, "probability", "observed")
    return c.select("bin", "n", F.round("mean_predicted", 9).alias("mean_predicted"),
                    F.round("observed_rate", 9).alias("observed_rate"))


@register("dq_min_weeks", FACT_WITH + """
SELECT user_id, count(*) AS weeks FROM fw WHERE sessions > 0 GROUP BY user_id HAVING count(*) >= 4""")
def dq_min_weeks(t):
    """Members with at least four active weeks."""
    return Q.min_weeks(facts(t))


@register("dq_outliers", with_adapters("body_tests") + """
SELECT test_id, user_id, weight FROM body_tests
WHERE abs(weight - (SELECT avg(weight) FROM body_tests)) > 5 * (SELECT stddev_samp(weight) FROM body_tests)""")
def dq_outliers(t):
    """Rows more than 5 standard deviations from the mean (global stats as scalar subqueries)."""
    return Q.outliers(t.adapters.body_tests, "weight").select("test_id", "user_id", "weight")


DQ_COLS = ("weight", "height", "fat_pct", "bmi")


def _dq_sql():
    parts = []
    for c in DQ_COLS:
        parts.append(f"""
  SELECT '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls,
         (count(*) - count({c})) / count(*) AS null_share, round(avg({c}), 6) AS mean,
         round(stddev_samp({c}), 6) AS std, min({c}) AS min, max({c}) AS max,
         min(CASE WHEN r >= ceil(0.25 * n) THEN {c} END) AS p25,
         min(CASE WHEN r >= ceil(0.5 * n) THEN {c} END) AS p50,
         min(CASE WHEN r >= ceil(0.75 * n) THEN {c} END) AS p75,
         (count(*) - count({c})) / count(*) > {config.DQ_NULL_SHARE_MAX} AS too_many_nulls
  FROM (SELECT {c}, row_number() OVER (ORDER BY {c}) AS r, count({c}) OVER () AS n FROM body_tests)""")
    return with_adapters("body_tests") + "SELECT * FROM (" + " UNION ALL ".join(parts) + ")"


@register("dq_feature_stats", _dq_sql())
def dq_feature_stats(t):
    """Per column: rows, nulls, null share, mean, std, min, max, quartiles, null-share flag."""
    s = Q.feature_stats(t.adapters.body_tests, DQ_COLS)
    return s.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


@register("feature_drift", with_adapters("body_tests") + """
, d AS (SELECT weight, tested_at < TIMESTAMP '2024-01-16 00:00:00' AS base FROM body_tests
        WHERE weight IS NOT NULL AND tested_at IS NOT NULL),
o AS (SELECT weight, row_number() OVER (ORDER BY weight) AS r, count(*) OVER () AS n FROM d WHERE base),
cut AS (SELECT min(weight) AS edge FROM o, range(1, 10) q(i) WHERE r >= greatest(ceil(CAST(i AS DOUBLE) / 10 * n), 1) GROUP BY i),
b AS (SELECT (SELECT count(*) FROM cut WHERE edge < weight) AS bin, base FROM d),
c AS (SELECT bin, sum(CAST(base AS BIGINT)) AS n_base, sum(CAST(NOT base AS BIGINT)) AS n_cur FROM b GROUP BY bin),
tot AS (SELECT sum(n_base) AS tb, sum(n_cur) AS tc FROM c)
SELECT 'weight' AS feature,
       round(sum((greatest(n_cur / tc, 0.0001) - greatest(n_base / tb, 0.0001))
                 * ln(greatest(n_cur / tc, 0.0001) / greatest(n_base / tb, 0.0001))), 9) AS psi,
       sum(n_base) AS baseline_rows, sum(n_cur) AS current_rows
FROM c, tot""")
def feature_drift(t):
    """Population stability index of body weight, first half of the month vs second half."""
    b = t.adapters.body_tests.filter(F.col("tested_at").isNotNull())
    base = F.col("tested_at") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    return Q.psi(b, "weight", base).withColumn("psi", F.round("psi", 9))


# ---- models ---------------------------------------------------------------------------
# A fit (train_..._fit) is checked by what holds for every right one: the rows and positives it was given, and that
# its optimality conditions leave no residual.  Scores themselves have no SQL.

FEATURES = ["length_days", "freeze_days", "start_month"]


def _period_features(t):
    """Features and label (null while its window is open) of every paid period, from one mart, written once."""
    kind = "period_id long, user_id long, length_days double, freeze_days double, start_month double, label boolean"
    if "training" not in t.saved:
        m = mart(t)
        f = m.select("period_id", "user_id", F.col("length_days").cast("double").alias("length_days"),
                     F.col("freeze_days").cast("double").alias("freeze_days"),
                     F.month("start_date").cast("double").alias("start_month"),
                     P.renewed_within(config.PERIOD_AS_OF, 30).alias("label"))
        path = scratch_path(t.spark, "training", uuid.uuid4().hex)
        f.write.parquet(path)
        t.saved["training"] = path
    return t.spark.read.schema(kind).parquet(t.saved["training"])


def _saved(t, name: str, kind, fit):
    """The model ``name`` of these tables: fitted and saved by the first query that asks, loaded by all."""
    if name not in t.saved:
        path = scratch_path(t.spark, "models", name, uuid.uuid4().hex)
        S.save_model(fit(), path, version())
        t.saved[name] = path
    return S.load_model(t.spark, t.saved[name], kind)


def _baseline(t):
    from pyspark.ml.classification import LogisticRegressionModel

    return _saved(t, "baseline", LogisticRegressionModel,
                  lambda: S.train_baseline(_period_features(t).filter("label is not null"), FEATURES, "label", key="period_id"))


def _trees(t):
    """The boosted trees, and their losses by round on the validation part."""
    from pyspark.ml.classification import GBTClassificationModel

    def fit():
        model, losses = S.train_trees(_period_features(t).filter("label is not null"), FEATURES, "label", key="period_id")
        t.saved["losses"] = json.dumps(list(losses))
        return model

    return _saved(t, "trees", GBTClassificationModel, fit), json.loads(t.saved["losses"])


def _hazard(t):
    from pyspark.ml.classification import LogisticRegressionModel

    return _saved(t, "hazard", LogisticRegressionModel, lambda: S.train_survival(_intervals(t), ["week_index"], reg=0.1))


def _intervals(t):
    """A row a week of every period begun, from its dates in one mart, written once: the weeks themselves, some dozens a
    period, aren't stored."""
    dates = ["period_id", "user_id", "start_date", "end_corrected", "next_start"]
    if "intervals" not in t.saved:
        path = scratch_path(t.spark, "training", uuid.uuid4().hex)
        mart(t).select(*dates).write.parquet(path)
        t.saved["intervals"] = path
    m = t.spark.read.schema("period_id long, user_id long, start_date date, end_corrected date, next_start date").parquet(t.saved["intervals"])
    return P.survival_intervals(m, config.PERIOD_AS_OF).select(F.col("week_index").cast("double").alias("week_index"), "event")


@register("train_baseline")
def train_baseline(t):
    """Logistic regression, 5-fold CV, on renewal labels; returns the coefficient table."""
    model = _baseline(t)
    coef = model.coefficients.toArray().tolist()
    return t.spark.createDataFrame([(f, float(c)) for f, c in zip(FEATURES, coef)] + [("intercept", model.intercept)],
                                   "feature string, coefficient double")


@register("train_trees")
def train_trees(t):
    """Boosted trees (depth 6, lr 0.01, up to 500 rounds, patience 50); returns feature importances."""
    return S.feature_importance(_trees(t)[0], FEATURES, t.spark)


@register("train_survival")
def train_survival(t):
    """Pooled discrete-time hazard (logistic, L2 0.1) on survival intervals; coefficient table."""
    model = _hazard(t)
    return t.spark.createDataFrame([("week_index", float(model.coefficients[0])), ("intercept", model.intercept)],
                                   "feature string, coefficient double")


LABELLED_SQL = MART_WITH + f"""
, lab AS (
  SELECT period_id, CASE WHEN next_start <= DATE '{config.PERIOD_AS_OF}' AND next_start <= end_corrected + 30 THEN true
                         WHEN DATE '{config.PERIOD_AS_OF}' < end_corrected + 30 THEN NULL ELSE false END AS label
  FROM mart)"""
SPELL_SQL = MART_WITH + f"""
, spell AS (
  SELECT start_date, CAST(floor((least(end_corrected, DATE '{config.PERIOD_AS_OF}') - start_date) / 7) AS INTEGER) + 1 AS weeks,
         end_corrected + 30 <= DATE '{config.PERIOD_AS_OF}'
           AND NOT COALESCE(next_start <= least(end_corrected + 30, DATE '{config.PERIOD_AS_OF}'), false) AS churned
  FROM mart WHERE start_date <= DATE '{config.PERIOD_AS_OF}')"""
COUNTS = "count(*) AS rows, count(*) FILTER (label) AS positives"


def _counts(label):
    return F.count("*").alias("rows"), F.count_if(label).alias("positives")


def _residual(model, df, features, label):
    """|mean probability - mean label|: zero at the optimum of a model with a free intercept.  Equal rows are scored once."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(S.assemble(S.equal_rows(df, features, label=F.col(label).cast("double")), features))
    off, n = vector_to_array(F.col("probability"))[1] - F.col("label"), F.col(S.COUNT)
    return scored.agg(F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("rows"),
                      F.coalesce(F.sum(F.when(F.col("label") == 1, n)), F.lit(0)).cast("long").alias("positives"),
                      F.abs(F.round(F.sum(n * off) / F.sum(n), 3)).alias("residual"))


@register("train_baseline_fit", LABELLED_SQL + f"SELECT {COUNTS}, 0.0::DOUBLE AS residual FROM lab WHERE label IS NOT NULL")
def train_baseline_fit(t):
    """Logistic regression, 5-fold CV, on renewal labels: rows, positives, residual of the intercept's condition."""
    df = _period_features(t).filter("label is not null")
    model = _baseline(t)
    return _residual(model, df, FEATURES, "label")


@register("train_trees_fit", LABELLED_SQL + f"SELECT {COUNTS}, 1.0::DOUBLE AS importance FROM lab WHERE label IS NOT NULL")
def train_trees_fit(t):
    """Boosted trees (depth 6, lr 0.01, up to 500 rounds, patience 50): rows, positives, sum of importances."""
    df = _period_features(t).filter("label is not null")
    model, _ = _trees(t)
    total = round(float(model.featureImportances.toArray().sum()), 6)
    return df.agg(*_counts(F.col("label")), F.lit(total).alias("importance"))


@register("train_survival_fit", SPELL_SQL + "SELECT sum(weeks)::BIGINT AS rows, count(*) FILTER (churned) AS positives, 0.0::DOUBLE AS residual FROM spell")
def train_survival_fit(t):
    """Pooled discrete-time hazard (logistic, L2 0.1) on survival intervals: rows, events, residual."""
    iv, model = _intervals(t), _hazard(t)
    return _residual(model, iv, ["week_index"], "event")


def _gradient_sql(source: str, rows: str, positives: str, features) -> str:
    """A row a coefficient: its gradient is zero."""
    names = ", ".join(f"('{f}')" for f in [*features, "intercept"])
    return f"{source} SELECT n.feature, 0.0::DOUBLE AS gradient, {rows} AS rows, {positives} AS positives FROM {{}}, (VALUES {names}) n(feature) {{}} GROUP BY n.feature"


def _gradient_rows(t, df, model, features, label, reg):
    g = S.logistic_gradient(model, df, features, label, reg)
    n = df.agg(F.count("*"), F.count_if(F.col(label))).first()
    return t.spark.createDataFrame([(f, abs(round(v, 5)), *n) for f, v in g.items()], "feature string, gradient double, rows long, positives long")


@register("train_baseline_gradient", _gradient_sql(LABELLED_SQL, "count(*)", "count(*) FILTER (label)", FEATURES).format("lab", "WHERE label IS NOT NULL"))
def train_baseline_gradient(t):
    """Every component of the logistic regression's gradient at the fitted coefficients: zero at the optimum only."""
    model = _baseline(t)
    return _gradient_rows(t, _period_features(t).filter("label is not null"), model, FEATURES, "label", model.getRegParam())


@register("train_survival_gradient", _gradient_sql(SPELL_SQL, "sum(weeks)::BIGINT", "count(*) FILTER (churned)", ["week_index"]).format("spell", ""))
def train_survival_gradient(t):
    """Every component of the pooled hazard's gradient at the fitted coefficients."""
    return _gradient_rows(t, _intervals(t), _hazard(t), ["week_index"], "event", 0.1)


@register("train_trees_patience", LABELLED_SQL + """SELECT count(*) AS rows, true AS least_loss, true AS patient FROM lab WHERE label IS NOT NULL""")
def train_trees_patience(t):
    """Rounds of the boosted trees: those kept have the least validation loss of all fitted, and 50 more (or the limit
    of 500) brought no lower one."""
    model, losses = _trees(t)
    kept = model.getNumTrees
    least = bool(losses) and abs(losses[kept - 1] - min(losses)) < 1e-12
    patient = len(losses) >= min(500, kept + 50)
    return _period_features(t).filter("label is not null").agg(F.count("*").alias("rows"), F.lit(least).alias("least_loss"), F.lit(patient).alias("patient"))


@register("train_aft_fit", SPELL_SQL + "SELECT count(*) AS rows, count(*) FILTER (churned) AS positives, 0.0::DOUBLE AS residual FROM spell")
def train_aft_fit(t):
    """Accelerated failure time (Weibull) on weeks held by season of the start: rows, events, residual of the intercept."""
    spells = P.spells(mart(t), config.PERIOD_AS_OF)
    path = scratch_path(t.spark, "training", uuid.uuid4().hex)
    spells.write.parquet(path)
    spells = t.spark.read.schema(spells.schema).parquet(path)
    model = S.train_aft(spells, ["start_month"], "weeks", "churned")
    z = (F.log("weeks") - F.log(F.col("prediction"))) / F.lit(model.scale)
    fitted = model.transform(S.assemble(spells, ["start_month"]))
    return fitted.agg(*_counts(F.col("churned")),
                      F.abs(F.round(F.avg(F.col("churned").cast("double") - F.exp(z)), 2)).alias("residual"))


def _scores(t):
    return S.batch_score(_baseline(t), _period_features(t), FEATURES, "period_id", config.PERIOD_AS_OF)


@register("batch_score")
def batch_score(t):
    """Score every paid period, open ones included, with the saved model fitted on the labelled ones;
    probability, band, score date."""
    return _scores(t)


@register("batch_score_snapshot", LABELLED_SQL + f"""
SELECT period_id, DATE '{config.PERIOD_AS_OF}' AS score_date, true AS is_probability, true AS in_band FROM mart""")
def batch_score_snapshot(t):
    """Scores written as a dated snapshot and read back: each period once, its score a probability within its band."""
    path = scratch_path(t.spark, "scores", uuid.uuid4().hex)
    S.write_scores(_scores(t), path)
    p = F.col("probability")
    return t.spark.read.parquet(path).select(
        "period_id", "score_date", p.between(0, 1).alias("is_probability"), S.risk_band(p).eqNullSafe(F.col("risk_band")).alias("in_band"))
