"""Scan, sink and profiling queries.

Queries that write do so under the session's shared checkpoint folder
(``spark.checkpoint.dir``), in a fresh sub-folder per call.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from renewlens.config import DRIVER_CONFIG as CFG
from renewlens.operators.calendar import calendar_for_years_of
from renewlens.plans import periods as P
from renewlens.plans.catalog import register
from renewlens.plans.oracle import with_adapters
from renewlens.plans.q_calendar import CAL_WITH
from renewlens.plans.q_periods import MART_WITH, mart
from renewlens.plans.profile import post_counts
from renewlens.session import scratch_path
from renewlens.sources import profile as prof
from renewlens.sources import schemas
from renewlens.sources.sinks import read_csv, stamp_audit, upsert, write_csv, write_table
from renewlens.sources.snapshots import read_latest_snapshot, write_snapshot
from renewlens.sources.tables import DRIVER_TABLES, scan, scan_between


def _scratch(t, name):
    return scratch_path(t.spark, "q", name, uuid.uuid4().hex)


@register("scan_table", """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 0 AND c_mktsegment = 'MACHINERY'""")
def scan_table(t):
    """Relational scan with pushed-down filter and pruned columns."""
    return scan(t.spark, f"{t.sf_dir}/customer.parquet",
                where=(F.col("c_acctbal") > 0) & (F.col("c_mktsegment") == "MACHINERY"),
                columns=["c_custkey", "c_name", "c_acctbal"])


@register("scan_documents", """
SELECT doc_id, lang, source, n_chars FROM documents WHERE n_chars > 2000""")
def scan_documents(t):
    """Any collection with a filter and a projection (limit optional)."""
    return scan(t.spark, f"{t.sf_dir}/documents.parquet", where=F.col("n_chars") > 2000,
                columns=["doc_id", "lang", "source", "n_chars"])


@register("scan_limit", "SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 10")
def scan_limit(t):
    """First n documents in key order (the limit is the feature)."""
    return scan(t.spark, f"{t.sf_dir}/documents.parquet", columns=["doc_id", "n_chars"]).orderBy("doc_id").limit(10)


@register("scan_sessions_between", with_adapters("activity") + """
SELECT activity_id, user_id, ts FROM activity
WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts <= TIMESTAMP '2024-01-14 23:59:59.999999'
  AND event_type = 'purchase'""")
def scan_sessions_between(t):
    """Activity in [lo, hi] (both inclusive), ANDed with an extra filter."""
    a = t.adapters.activity
    return scan_between(a, "ts", "2024-01-08 00:00:00", "2024-01-14 23:59:59.999999",
                        where=F.col("event_type") == "purchase").select("activity_id", "user_id", "ts")


@register("scan_memberships", with_adapters("periods") + """
SELECT period_id, user_id, start_date FROM periods WHERE plan_id IN ('1-URGENT', '2-HIGH')""")
def scan_memberships(t):
    """Membership documents with a filter and a projection."""
    return t.adapters.periods.filter(F.col("plan_id").isin("1-URGENT", "2-HIGH")).select(
        "period_id", "user_id", "start_date")


@register("null_profile", with_adapters("body_tests") + """
SELECT column_name, dtype, nulls FROM (
  SELECT 'test_id' AS column_name, 'bigint' AS dtype, count(*) - count(test_id) AS nulls FROM body_tests
  UNION ALL SELECT 'user_id', 'bigint', count(*) - count(user_id) FROM body_tests
  UNION ALL SELECT 'tested_at', 'timestamp_ntz', count(*) - count(tested_at) FROM body_tests
  UNION ALL SELECT 'weight', 'double', count(*) - count(weight) FROM body_tests
  UNION ALL SELECT 'height', 'double', count(*) - count(height) FROM body_tests
  UNION ALL SELECT 'fat_pct', 'double', count(*) - count(fat_pct) FROM body_tests
  UNION ALL SELECT 'bmi', 'double', count(*) - count(bmi) FROM body_tests)""")
def null_profile(t):
    """Missing values per column (one aggregate + unpivot)."""
    return prof.null_profile(t.adapters.body_tests)


@register("schema_profile", """
WITH s AS (SELECT * FROM customer ORDER BY c_custkey LIMIT 100),
l AS (
  SELECT c_custkey AS k, 'c_custkey' AS field, 'bigint' AS type, CAST(c_custkey AS VARCHAR) AS value FROM s
  UNION ALL SELECT c_custkey, 'c_name', 'string', c_name FROM s
  UNION ALL SELECT c_custkey, 'c_nationkey', 'int', CAST(c_nationkey AS VARCHAR) FROM s
  UNION ALL SELECT c_custkey, 'c_acctbal', 'double', CAST(c_acctbal AS VARCHAR) FROM s
  UNION ALL SELECT c_custkey, 'c_mktsegment', 'string', c_mktsegment FROM s)
SELECT field, type, array_to_string(list(COALESCE(value, 'null') ORDER BY k)[1:5], ' | ') AS sample_values
FROM l GROUP BY field, type""")
def schema_profile(t):
    """Per field of a 100-row key-ordered sample: type and first five values."""
    return prof.schema_profile(t.customer, 100, "c_custkey")


@register("collection_counts", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in DRIVER_TABLES))
def collection_counts(t):
    """Row count of every source table."""
    return prof.collection_counts({n: t.table(n) for n in DRIVER_TABLES})


@register("write_table", CAL_WITH + "SELECT * FROM cal UNION ALL SELECT * FROM cal WHERE is_holiday")
def write_table_q(t):
    """Write modes: replace then append (append repeats rows), read back."""
    path = _scratch(t, "write_table")
    cal = calendar_for_years_of(t.orders, "o_orderdate")
    write_table(cal, path, "replace")
    write_table(cal.filter("is_holiday"), path, "append")
    return t.spark.read.parquet(path)


@register("write_csv", with_adapters("freezes") + """
SELECT user_id, period_id, CAST(SUM(CASE WHEN start_date IS NOT NULL AND end_date IS NOT NULL
                                         THEN end_date - start_date + 1 ELSE 0 END) AS INTEGER) AS freeze_days
FROM freezes GROUP BY user_id, period_id""")
def write_csv_q(t):
    """CSV with header, read back with an explicit schema."""
    path = _scratch(t, "write_csv")
    write_csv(P.freeze_days(t.adapters.freezes), path)
    return read_csv(t.spark, path, "user_id long, period_id long, freeze_days int")


@register("read_latest_snapshot", with_adapters("posts") + """
SELECT user_id, count(*) AS feed_posts_total FROM posts WHERE status = 'posted' GROUP BY user_id""")
def read_latest_snapshot_q(t):
    """Two snapshots (older with stale counts, newer current); consumers read the newest."""
    path = _scratch(t, "snapshots")
    counts = post_counts(t.adapters.posts)
    write_snapshot(counts.withColumn("feed_posts_total", F.col("feed_posts_total") - 1), path, "20240101_000000")
    write_snapshot(counts, path, "20240201_000000")
    return read_latest_snapshot(t.spark, path, counts.schema)


UPSERT_SQL = CAL_WITH + """
, y AS (SELECT min(year) AS y0 FROM cal),
tgt AS (SELECT dt, season_label, is_holiday FROM cal, y WHERE year <= y0 + 3),
src AS (SELECT dt, upper(season_label) AS season_label, NOT is_holiday AS is_holiday FROM cal, y WHERE year >= y0 + 2)
SELECT COALESCE(t.dt, s.dt) AS dt,
       CASE WHEN s.dt IS NOT NULL THEN s.season_label ELSE t.season_label END AS season_label,
       CASE WHEN t.dt IS NOT NULL THEN t.is_holiday ELSE s.is_holiday END AS is_holiday
FROM tgt t FULL OUTER JOIN src s ON t.dt = s.dt"""


def _halves(t):
    cal = calendar_for_years_of(t.orders, "o_orderdate")
    y0 = cal.agg(F.min("year")).scalar()
    tgt = cal.filter(F.col("year") <= y0 + 3).select("dt", "season_label", "is_holiday")
    src = cal.filter(F.col("year") >= y0 + 2).select("dt", F.upper("season_label").alias("season_label"),
                                                     (~F.col("is_holiday")).alias("is_holiday"))
    return tgt, src


@register("upsert", UPSERT_SQL)
def upsert_q(t):
    """Insert new keys, update chosen columns of matched keys, keep the rest."""
    tgt, src = _halves(t)
    return upsert(tgt, src, ["dt"], update_cols=["season_label"])


STAMP_SQL = (CAL_WITH + """
, y AS (SELECT min(year) AS y0 FROM cal),
tgt AS (SELECT dt, season_label FROM cal, y WHERE year <= y0 + 3),
src AS (SELECT dt, upper(season_label) AS season_label FROM cal, y WHERE year >= y0 + 2)
SELECT COALESCE(t.dt, s.dt) AS dt,
       CASE WHEN s.dt IS NOT NULL THEN s.season_label ELSE t.season_label END AS season_label,
       CASE WHEN t.dt IS NOT NULL THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END
         AS created_at,
       CASE WHEN s.dt IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END
         AS updated_at
FROM tgt t FULL OUTER JOIN src s ON t.dt = s.dt""")


@register("stamp_audit", STAMP_SQL)
def stamp_audit_q(t):
    """created_at/updated_at on insert; an upsert refreshes only updated_at."""
    tgt, src = _halves(t)
    t1 = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    t2 = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    tgt = stamp_audit(tgt.drop("is_holiday"), t1)
    src = stamp_audit(src.drop("is_holiday"), t2)
    return upsert(tgt, src, ["dt"], update_cols=["season_label", "updated_at"])


@register("apply_mart_schema", MART_WITH + """
SELECT CAST(period_id AS VARCHAR) AS period_id, CAST(user_id AS VARCHAR) AS user_id, plan_name, facility_corr,
       start_date, end_date, end_corrected, CAST(length_days AS INTEGER) AS length_days,
       COALESCE(freeze_days, 0) AS freeze_days, next_start, CAST(days_to_next AS INTEGER) AS days_to_next, renewed,
       CAST(gap_days AS INTEGER) AS gap_days
FROM mart""")
def apply_mart_schema(t):
    """Conform the period mart to its table schema (types, column order, defaults)."""
    return schemas.conform(mart(t), schemas.PERIOD_MART, schemas.PERIOD_MART_DEFAULTS)


__all__ = ["CFG"]
