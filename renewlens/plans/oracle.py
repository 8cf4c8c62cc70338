"""DuckDB SQL for the oracle: the adapters of ``sources/adapters.py`` re-stated
in SQL, plus shared CTE fragments.  Each query's SQL is independent of the Spark
plan that it checks."""

from __future__ import annotations

from renewlens.config import DRIVER_CONFIG

ADAPTERS = {
    "members": """
members AS (
  SELECT c_custkey AS user_id, c_name AS nickname, c_nationkey AS facility_id,
         split_part(c_name, '#', 1) AS firstname, split_part(c_name, '#', -1) AS lastname,
         CASE WHEN c_custkey % 8 <> 0 THEN '+' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') END AS phone,
         CASE WHEN c_custkey % 13 = 0 THEN 'staff' ELSE 'user' END AS role,
         CASE WHEN c_custkey % 17 = 0 THEN 'partner' END AS partnership,
         CASE WHEN c_custkey % 9 = 0 THEN '1990/01/02'
              ELSE lpad(CAST(1 + c_custkey % 31 AS VARCHAR), 2, '0') || '-' ||
                   lpad(CAST(1 + c_custkey % 12 AS VARCHAR), 2, '0') || '-' ||
                   CAST(1950 + c_custkey % 65 AS VARCHAR) END AS birthday,
         CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CAST(50 + c_custkey % 50 AS DOUBLE) AS weight,
         CAST(150 + c_custkey % 40 AS DOUBLE) AS height,
         DATE '1994-01-01' + CAST(c_custkey % 2500 AS INTEGER) AS created_date
  FROM customer)""",
    "facilities": """
facilities AS (
  SELECT n_nationkey AS facility_id, n_name AS name,
         CASE WHEN n_nationkey % 5 <> 4 THEN CAST(432000 + 50 * n_nationkey AS DOUBLE) / 10000 END AS lat,
         CASE WHEN n_nationkey % 5 <> 4 THEN CAST(769000 + 70 * n_nationkey AS DOUBLE) / 10000 END AS lon
  FROM nation)""",
    "facility_names": """
facility_names AS (
  SELECT n_nationkey AS facility_id, n_name AS name FROM nation WHERE n_regionkey <> 3)""",
    "plans": """
plans AS (
  SELECT plan_id,
         CASE plan_id WHEN '1-URGENT' THEN 'annual' WHEN '2-HIGH' THEN 'annual'
                      WHEN '3-MEDIUM' THEN 'half_year' WHEN '5-LOW' THEN 'trial' ELSE 'other' END AS name
  FROM (SELECT DISTINCT o_orderpriority AS plan_id FROM orders))""",
    "periods": """
periods AS (
  SELECT o_orderkey AS period_id, o_custkey AS user_id, o_orderpriority AS plan_id,
         CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey % 25 AS INTEGER) END AS facility_id,
         CAST(o_orderdate AS DATE) AS start_date,
         CAST(o_orderdate AS DATE) + CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 364
                                          WHEN o_orderpriority = '3-MEDIUM' THEN 181 ELSE 13 END AS end_date,
         CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate END AS created_at
  FROM orders)""",
    "freezes": """
freezes AS (
  SELECT o.o_custkey AS user_id, l.l_orderkey AS period_id, CAST(l.l_shipdate AS DATE) AS start_date,
         CASE WHEN l.l_linenumber <> 7
              THEN CAST(l.l_shipdate AS DATE) + CAST(floor(l.l_quantity) AS INTEGER) % 14 END AS end_date
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE l.l_returnflag = 'R')""",
    "trials": """
trials AS (
  SELECT period_id AS event_id, user_id, start_date AS trial_start,
         CASE WHEN period_id % 3 = 0 THEN 'full_week' WHEN period_id % 3 = 1 THEN 'intro_course'
              ELSE 'single_visit' END AS trial_kind
  FROM periods WHERE plan_id = '5-LOW')""",
    "measures": """
measures AS (
  SELECT event_id AS measure_id, user_id, IF(event_type = 'click', 'assessment', 'lifted_weight') AS kind,
         ts AS measured_at, value
  FROM events WHERE event_type IN ('click', 'purchase'))""",
    "payments": """
payments AS (
  SELECT o.o_custkey AS user_id, l.l_orderkey AS event_id,
         CASE WHEN l.l_linenumber <> 5 THEN l.l_discount END AS amount,
         CASE l.l_returnflag WHEN 'A' THEN 'adminAdd' WHEN 'N' THEN 'added' ELSE 'card' END AS type,
         CASE WHEN l.l_linenumber = 1 THEN 'voucher for a week' ELSE 'purchase' END AS name
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE l.l_tax < 0.03)""",
    "body_tests": """
body_tests AS (
  SELECT event_id AS test_id, user_id, CASE WHEN event_id % 11 <> 0 THEN ts END AS tested_at,
         value AS weight, CAST(150 + event_id % 40 AS DOUBLE) AS height,
         round(value / 3.0, 2) AS fat_pct, round(value / 2.5, 1) AS bmi
  FROM events WHERE event_type = 'view')""",
    "friend_counts": """
friend_counts AS (
  SELECT event_id AS row_id, user_id, ts AS as_of, CAST(event_id % 40 AS INTEGER) AS friends
  FROM events WHERE event_type = 'signup')""",
    "posts": """
posts AS (
  SELECT event_id AS post_id, user_id, CASE WHEN value < 10 THEN 'draft' ELSE 'posted' END AS status
  FROM events WHERE event_type = 'click')""",
    "groups": """
groups AS (
  SELECT s_suppkey AS group_id, (s_suppkey * 7) % 1500 AS admin,
         CASE WHEN s_suppkey % 4 <> 0 THEN [3 * s_suppkey, 3 * s_suppkey + 1] END AS users,
         CASE WHEN s_suppkey % 2 <> 0 THEN [5 * s_suppkey] END AS mentors
  FROM supplier)""",
    "answers": """
answers AS (
  SELECT conv_id * 1000 + turn AS answer_id, conv_id % 150 AS user_id,
         CASE WHEN turn % 5 = 4 THEN 'Your body type and primary goal?'
              WHEN turn % 3 = 0 THEN 'Do you keep an active lifestyle?'
              WHEN turn % 3 = 1 THEN 'Which body type describes you?'
              ELSE 'What is your primary goal?' END AS question,
         text AS answer,
         turn * 1000000 + conv_id AS created_seq,
         CASE WHEN conv_id % 4 = 0 THEN turn * 1000000 + conv_id + 500000 END AS updated_seq
  FROM conversations WHERE role = 'user')""",
    "test_accounts": """
test_accounts AS (
  SELECT c_custkey AS user_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'internal' ELSE 'other' END AS free_pass_type
  FROM customer WHERE c_acctbal < 0)""",
    "member_locations": """
member_locations AS (
  SELECT event_id AS point_id, user_id,
         CASE WHEN NOT ((event_type = 'error' AND event_id % 2 = 0) OR (user_id % 10 = 0 AND event_id % 40 <> 0)) THEN
           CAST(432000 + 130 * (user_id % 5) + 37 * (CASE user_id % 3 WHEN 0 THEN event_id % 2
                 WHEN 1 THEN event_id % 4 ELSE event_id % 9 END) AS DOUBLE) / 10000
             + CAST(0.00001 AS DOUBLE) * (event_id % 3) END AS latitude,
         CASE WHEN NOT ((event_type = 'error' AND event_id % 2 = 0) OR (user_id % 10 = 0 AND event_id % 40 <> 0)) THEN
           CAST(769000 + 90 * (user_id % 7) + 53 * (CASE user_id % 3 WHEN 0 THEN event_id % 2
                 WHEN 1 THEN event_id % 4 ELSE event_id % 9 END) AS DOUBLE) / 10000
             + CAST(0.00001 AS DOUBLE) * (event_id % 2) END AS longitude,
         ts AS created_at
  FROM events)""",
    "activity": """
activity AS (
  SELECT event_id AS activity_id, user_id, ts, event_type, value, event_id % 7 AS trainer_id FROM events)""",
    "usage": """
usage AS (
  SELECT user_id, ts, CASE event_type WHEN 'view' THEN 'time_in_app' WHEN 'click' THEN 'steps' WHEN 'signup' THEN 'assessment_frequency'
                                      WHEN 'purchase' THEN 'hrm_usage' ELSE 'weight_entries' END AS metric,
         CAST(CASE event_type WHEN 'view' THEN event_id % 90 WHEN 'click' THEN 10 * (event_id % 997) ELSE 1 END AS DOUBLE) AS amount
  FROM events)""",
    "scores": """
scores AS (
  SELECT c_custkey AS user_id, CAST(c_custkey % 101 AS DOUBLE) / 100 AS probability,
         CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 1 END AS observed
  FROM customer)""",
}

# Adapter dependencies (an adapter may read another adapter).
DEPS = {"trials": ["periods"]}


def rules_values() -> str:
    rows = ", ".join(f"('{r.facility}', DATE '{r.cutoff.isoformat()}', '{r.replacement}')"
                     for r in DRIVER_CONFIG.facility_rules)
    return f"rules(rule_facility, cutoff, replacement) AS (VALUES {rows})"


def with_adapters(*names: str, extra: str = "") -> str:
    """``WITH`` clause holding the named adapters (dependencies first) and extra CTEs."""
    order: list[str] = []

    def add(n):
        for d in DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = [ADAPTERS[n].strip() for n in order]
    if extra:
        ctes.append(extra.strip())
    return "WITH " + ",\n".join(ctes) + "\n"


def sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)
