"""Queries over histories: as-of lookups, unions of intervals."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from renewlens.config import DRIVER_CONFIG as CFG
from renewlens.operators import norm_state as N
from renewlens.operators import sketches as K
from renewlens.operators import weekly as W
from renewlens.operators.asof import asof_join
from renewlens.operators.intervals import merged_intervals
from renewlens.plans import periods as P
from renewlens.plans.catalog import register
from renewlens.plans.oracle import with_adapters
from renewlens.plans.q_declared import ALPHA, EWMA_CTES
from renewlens.plans.q_periods import MART_WITH, mart
from renewlens.session import scratch_path
from renewlens.sources.documents import document_profile
from renewlens.sources.partitioned import read_table, upsert_partitions, write_bucketed
from renewlens.sources.sinks import store
from renewlens.sources.tables import scan_between


@register("activity_period", MART_WITH + """
, seen AS (SELECT event_id AS activity_id, user_id, CAST(ts AS DATE) AS day FROM events)
SELECT s.activity_id, s.user_id, s.day, (SELECT arg_max(m.period_id, (m.start_date, m.period_id)) FROM mart m
         WHERE m.user_id = s.user_id AND m.start_date <= s.day) AS period_id
FROM seen s""")
def activity_period(t):
    """Each activity with the membership period its member began last (as-of join; null before the first)."""
    a = t.adapters.activity.select("activity_id", "user_id", F.to_date("ts").alias("day"))
    return asof_join(a, mart(t), "user_id", "day", "start_date", ["period_id"], tie=["period_id"])


@register("freeze_days_merged", with_adapters("periods", "freezes") + """
SELECT f.user_id, f.period_id, CAST(count(DISTINCT d.day) AS INTEGER) AS freeze_days
FROM freezes f JOIN periods p ON p.user_id = f.user_id AND p.period_id = f.period_id,
     LATERAL (SELECT unnest(generate_series(f.start_date, f.end_date, INTERVAL 1 DAY)) AS day) d
WHERE d.day BETWEEN p.start_date AND p.end_date
GROUP BY ALL""")
def freeze_days_merged(t):
    """Per (member, period): days of the period with at least one freeze (overlaps once, clipped)."""
    a = t.adapters
    return P.freeze_days_merged(a.freezes, a.periods).filter("freeze_days > 0")


@register("freeze_spans", with_adapters("freezes") + """
, days AS (SELECT DISTINCT user_id, CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS day
           FROM freezes WHERE end_date IS NOT NULL),
runs AS (SELECT user_id, day, day - CAST(row_number() OVER (PARTITION BY user_id ORDER BY day) AS INTEGER) AS run FROM days)
SELECT user_id, min(day) AS start_date, max(day) AS end_date, CAST(count(*) AS INTEGER) AS days
FROM runs GROUP BY user_id, run""")
def freeze_spans(t):
    """Stretches of days on which a member is frozen, whatever the period (overlapping and neighbouring freezes merged)."""
    m = merged_intervals(t.adapters.freezes, ["user_id"], "start_date", "end_date")
    return m.withColumn("days", F.datediff("end_date", "start_date") + 1)


@register("period_mart_merged", MART_WITH + """
, days AS (
  SELECT f.user_id, f.period_id, count(DISTINCT d.day) AS n
  FROM freezes f JOIN periods p ON p.user_id = f.user_id AND p.period_id = f.period_id,
       LATERAL (SELECT unnest(generate_series(f.start_date, f.end_date, INTERVAL 1 DAY)) AS day) d
  WHERE d.day BETWEEN p.start_date AND p.end_date GROUP BY ALL)
SELECT m.period_id, m.user_id, CAST(COALESCE(n, 0) AS INTEGER) AS freeze_days, m.end_date + CAST(COALESCE(n, 0) AS INTEGER) AS end_corrected,
       m.next_start
FROM mart m LEFT JOIN days d ON d.user_id = m.user_id AND d.period_id = m.period_id""")
def period_mart_merged(t):
    """The period mart with each frozen day of a period counted once."""
    return mart(t, merge_overlaps=True).select("period_id", "user_id", "freeze_days", "end_corrected", "next_start")


NORMS = StructType().add("user_id", "long").add("sessions", "double").add("sessions_ewma", "double").add("week", "date")


@register("ewma_norm_incremental", EWMA_CTES + "SELECT user_id, week, CAST(sessions AS DOUBLE) AS sessions, round(ewma, 6) AS sessions_ewma FROM e")
def ewma_norm_incremental(t):
    """Norms kept by state: three runs, each of what arrived since the last (some of it for weeks long past), equal one run
    over all activity."""
    a = t.adapters.activity
    late = F.col("activity_id") % 11 == 0
    batches = [a.filter("ts < timestamp_ntz'2024-01-12'").filter(~late),
               a.filter("ts >= timestamp_ntz'2024-01-12' and ts < timestamp_ntz'2024-01-20'"),
               a.filter("ts >= timestamp_ntz'2024-01-20'").unionByName(a.filter("ts < timestamp_ntz'2024-01-12'").filter(late))]
    path = scratch_path(t.spark, "norms", uuid.uuid4().hex)
    state = t.spark.createDataFrame([], N.STATE)
    for i, batch in enumerate(batches):
        arrived = batch.groupBy("user_id", W.week_start("ts").alias("week")).agg(F.count("*").alias("sessions"))
        norms = read_table(t.spark, path, NORMS, "week")
        state, changed = N.advance(state, norms, arrived, "sessions", ALPHA)
        state = store(state, "norm-state")
        upsert_partitions(store(changed.select(*NORMS.fieldNames()), "norm-changes"), path, ["user_id", "week"], "week", f"{i:04d}")
    return read_table(t.spark, path, NORMS, "week").withColumn("sessions_ewma", F.round("sessions_ewma", 6))


PERIODS = StructType().add("period_id", "long").add("user_id", "long").add("plan_id", "string").add("end_date", "date").add("year", "integer")


@register("upsert_partitioned", with_adapters("periods") + """
, old AS (SELECT period_id, user_id, plan_id, end_date, year(start_date) AS year FROM periods WHERE period_id % 3 <> 0),
new AS (SELECT period_id, user_id, 'changed' AS plan_id, end_date + 1 AS end_date, year(start_date) AS year FROM periods
        WHERE year(start_date) = (SELECT max(year(start_date)) FROM periods) AND period_id % 2 = 0)
SELECT COALESCE(o.period_id, n.period_id) AS period_id, COALESCE(o.user_id, n.user_id) AS user_id,
       COALESCE(n.plan_id, o.plan_id) AS plan_id, COALESCE(o.end_date, n.end_date) AS end_date, CAST(COALESCE(o.year, n.year) AS INTEGER) AS year
FROM old o FULL JOIN new n ON n.period_id = o.period_id AND n.year = o.year""")
def upsert_partitioned(t):
    """Copy-on-write upsert: periods by year, the last year's rewritten, the others carried over by the manifest."""
    path = scratch_path(t.spark, "periods", uuid.uuid4().hex)
    p = t.adapters.periods.withColumn("year", F.year("start_date"))
    cols = PERIODS.fieldNames()
    upsert_partitions(p.filter("period_id % 3 <> 0").select(*cols), path, ["period_id", "year"], "year", "0001")
    last = p.agg(F.max("year")).scalar()
    changed = (p.filter((F.col("year") == last) & (F.col("period_id") % 2 == 0))
               .withColumn("plan_id", F.lit("changed")).withColumn("end_date", F.date_add("end_date", 1)).select(*cols))
    upsert_partitions(store(changed, "changed"), path, ["period_id", "year"], "year", "0002", update_cols=["plan_id"])
    return read_table(t.spark, path, PERIODS, "year")


#: Buckets of the laid-out tables; a cluster takes some thousands, the same for all tables of a member.
BUCKETS = 8


def _laid_out(t, name: str, df, by=("user_id",), partition_by=()):
    """``df`` as a bucketed table of this session, written by the first query that asks."""
    key = f"table {name}"
    if key not in t.saved:
        tag = uuid.uuid4().hex
        write_bucketed(df, f"renewlens_{name}_{tag}", scratch_path(t.spark, "tables", name, tag), BUCKETS, by, partition_by)
        t.saved[key] = f"renewlens_{name}_{tag}"
    return t.spark.table(t.saved[key])


@register("scan_sessions_partitioned", with_adapters("activity") + """
SELECT activity_id, user_id, ts, CAST(ts AS DATE) AS day FROM activity WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'
  AND event_type = 'purchase'""")
def scan_sessions_partitioned(t):
    """Activity laid out by day and bucketed by member: a range of days lists their folders only."""
    a = t.adapters.activity
    laid = _laid_out(t, "activity", a.withColumn("day", F.to_date("ts")), partition_by=["day"])
    days = scan_between(laid, "day", F.lit("2024-01-08").cast("date"), F.lit("2024-01-14").cast("date"), where=F.col("event_type") == "purchase")
    return days.select("activity_id", "user_id", "ts", "day")


@register("period_mart_bucketed", MART_WITH + "SELECT * FROM mart")
def period_mart_bucketed(t):
    """The period mart over tables bucketed by member: its joins on the member need no exchange."""
    return bucketed_mart(t)


def bucketed_mart(t):
    a = t.adapters
    plans = F.broadcast(a.plans)    # five rows, by construction
    return P.period_mart(_laid_out(t, "periods", a.periods), plans, _laid_out(t, "freezes", a.freezes), _laid_out(t, "members", a.members),
                         a.facilities, P.rules_table(t.spark, CFG.facility_rules), CFG.paid_plans, spread_null_members=False)


_NODES = """
m AS (SELECT c_custkey AS k, c_name, c_mktsegment, c_custkey % 97 <> 0 AND c_custkey % 89 <> 0 AS ok FROM customer),
n(k, path, type, value, place) AS (
  SELECT k, '$', CASE WHEN k % 97 = 0 THEN 'missing' WHEN k % 89 = 0 THEN 'invalid' ELSE 'object' END, NULL, 0 FROM m
  UNION ALL SELECT k, '$.id', 'long', CAST(k AS VARCHAR), 0 FROM m WHERE ok
  UNION ALL SELECT k, '$.name', 'string', c_name, 0 FROM m WHERE ok
  UNION ALL SELECT k, '$.phone', ['long', 'string', 'null'][k % 3 + 1], [CAST(k AS VARCHAR), '+' || k, 'null'][k % 3 + 1], 0 FROM m WHERE ok
  UNION ALL SELECT k, '$.profile', 'object', NULL, 0 FROM m WHERE ok
  UNION ALL SELECT k, '$.profile.segment', 'string', c_mktsegment, 0 FROM m WHERE ok
  UNION ALL SELECT k, '$.profile.scores', 'array', NULL, 0 FROM m WHERE ok
  UNION ALL SELECT k, '$.profile.scores[]', 'long', CAST(k % 7 AS VARCHAR), 0 FROM m WHERE ok
  UNION ALL SELECT k, '$.profile.scores[]', IF(k % 4 = 0, 'string', 'decimal'), IF(k % 4 = 0, 'n/a', k % 11 || '.5'), 1 FROM m WHERE ok
  UNION ALL SELECT k, '$.groups', IF(k % 5 < 2, 'array', 'null'), 'null', 0 FROM m WHERE ok
  UNION ALL SELECT k, '$.groups[]', 'object', NULL, i FROM m, range(2) r(i) WHERE ok AND k % 5 = 1
  UNION ALL SELECT k, '$.groups[].id', 'long', CAST(k + i AS VARCHAR), i FROM m, range(2) r(i) WHERE ok AND k % 5 = 1
  UNION ALL SELECT k, '$.groups[].role', 'string', 'admin', 0 FROM m WHERE ok AND k % 5 = 1)"""


@register("document_profile", "WITH" + _NODES + """
SELECT path, type, count(DISTINCT k) AS documents, count(*) AS nodes,
       (SELECT count(DISTINCT type) FROM n o WHERE o.path = n.path AND type NOT IN ('null', 'missing')) > 1 AND type <> 'none' AS mixed,
       CASE WHEN type NOT IN ('object', 'array', 'missing', 'invalid') THEN array_to_string(list(value ORDER BY k, place)[1:5], ' | ') END AS sample_values
FROM n GROUP BY path, type""")
def document_profile_q(t):
    """Paths of JSON documents at any depth, with the types found there and first values (VARIANT, unnested)."""
    return document_profile(t.adapters.member_documents, "doc_key", "doc")


DRIFT_FEATURES = ("weight", "height", "fat_pct", "bmi")


@register("feature_drift_sketch", with_adapters("body_tests") + " UNION ALL ".join(
    f"""SELECT '{f}' AS feature, count({f}) FILTER (tested_at < TIMESTAMP '2024-01-16 00:00:00') AS baseline_rows,
    count({f}) FILTER (tested_at >= TIMESTAMP '2024-01-16 00:00:00') AS current_rows, true AS shares_close, true AS psi_close FROM body_tests""" for f in DRIFT_FEATURES))
def feature_drift_sketch(t):
    """Drift of four features from stored daily sketches, one scan for all of them: each bin's share lies within the sketches'
    bound of the rows' own, and the index is that of these shares."""
    b = t.adapters.body_tests.filter("tested_at is not null").withColumn("day", F.to_date("tested_at"))
    kept = store(K.feature_sketches(b, "day", DRIFT_FEATURES), "sketches")
    d = K.sketch_drift(kept, F.col("run") < F.lit("2024-01-16").cast("date"))
    cuts = d.select("feature", "cuts", "base_shares", "cur_shares", "psi", "baseline_rows", "current_rows")
    long = b.select((F.col("day") < F.lit("2024-01-16").cast("date")).alias("base"), F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("x")) for f in DRIFT_FEATURES))).alias("f"))
    bins = long.select("base", "f.*").filter("x is not null").join(F.broadcast(cuts.select("feature", "cuts")), "feature")
    bins = bins.withColumn("bin", F.size(F.filter("cuts", lambda c: c < F.col("x"))))
    true = bins.groupBy("feature", "bin").agg(F.count_if("base").alias("nb"), F.count_if(~F.col("base")).alias("nc"))
    bound = K.share_error()
    each = true.join(cuts, "feature").withColumns({"pb": F.col("nb") / F.col("baseline_rows"), "pc": F.col("nc") / F.col("current_rows")})
    off = F.greatest(F.abs(F.col("pb") - F.col("base_shares")[F.col("bin")]), F.abs(F.col("pc") - F.col("cur_shares")[F.col("bin")]))
    # the index is linear in small changes of the shares: each may be off by the bound
    psi = F.sum((F.greatest("pc", F.lit(1e-4)) - F.greatest("pb", F.lit(1e-4))) * F.log(F.greatest("pc", F.lit(1e-4)) / F.greatest("pb", F.lit(1e-4))))
    slack = F.sum(4 * bound * (F.abs(F.log(F.greatest("pc", F.lit(1e-4)) / F.greatest("pb", F.lit(1e-4)))) + F.abs(F.col("pc") - F.col("pb")) / F.greatest("pb", F.lit(1e-4)) + bound / F.greatest("pb", F.lit(1e-4))))
    return each.groupBy("feature", "baseline_rows", "current_rows").agg(
        (F.max(off) <= 2 * bound).alias("shares_close"), (F.abs(psi - F.first("psi")) <= slack).alias("psi_close"))


@register("distinct_members_by_range", with_adapters("periods") + """
, month AS (SELECT DISTINCT CAST(date_trunc('month', start_date) AS DATE) AS last_month FROM periods)
SELECT last_month, (SELECT count(DISTINCT user_id) FROM periods p WHERE p.start_date >= last_month - INTERVAL 2 MONTH
                      AND p.start_date < last_month + INTERVAL 1 MONTH) AS members, true AS close
FROM month""")
def distinct_members_by_range(t):
    """Members who began a period within three months: exact count, and whether the estimate from monthly sketches is within 3 %."""
    p = t.adapters.periods.withColumn("month", F.trunc("start_date", "month"))
    kept = store(K.distinct_sketches(p, F.col("month"), "user_id"), "sketches")
    estimate = K.distinct_over(kept, 3).withColumnRenamed("members", "estimate")
    three = F.explode(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.add_months("month", i))).alias("last_period")
    exact = p.select(three, "user_id").distinct().groupBy("last_period").agg(F.count("user_id").alias("members"))
    return exact.join(estimate, "last_period").select(
        F.col("last_period").alias("last_month"), "members", (F.abs(F.col("estimate") - F.col("members")) <= 0.03 * F.col("members")).alias("close"))


@register("usage_factors", with_adapters("usage") + """
, w AS (SELECT user_id, CAST(date_trunc('week', ts) AS DATE) AS week, metric, sum(amount) AS x FROM usage GROUP BY ALL),
s AS (SELECT user_id, CAST(unnest(generate_series(min(week), max(week), INTERVAL 7 DAY)) AS DATE) AS week FROM w GROUP BY user_id),
f AS (SELECT s.user_id, s.week, """ + ", ".join(f"COALESCE(sum(x) FILTER (metric = '{m}'), 0) AS {m}" for m in W.USAGE) + """
      FROM s LEFT JOIN w ON w.user_id = s.user_id AND w.week = s.week GROUP BY ALL)
SELECT user_id, week, """ + ", ".join(f"round({m} - avg({m}) OVER v, 6) AS {m}_delta" for m in W.USAGE) + """
FROM f WINDOW v AS (PARTITION BY user_id ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def usage_factors(t):
    """Time in app, steps, assessments, heart-rate monitor use and weight entries per week against the member's own mean."""
    u = W.usage_factors(t.adapters.usage)
    return u.select("user_id", "week", *(F.round(f"{m}_delta", 6).alias(f"{m}_delta") for m in W.USAGE))
