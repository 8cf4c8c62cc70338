"""Adapters: shape the driver tables like the raw tables the marts read.

Pure projections (plus the owner lookup that a raw freeze/payment row carries).
The same definitions are written in DuckDB SQL in ``renewlens/plans/oracle.py``;
both must change together.
"""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRIORITY_PLAN = (("1-URGENT", "annual"), ("2-HIGH", "annual"), ("3-MEDIUM", "half_year"), ("5-LOW", "trial"))
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
PLAN_DAYS = (("annual", 364), ("half_year", 181))
OTHER_PLAN_DAYS = 13
QUESTIONS = ("Do you keep an active lifestyle?", "Which body type describes you?", "What is your primary goal?",
             "Your body type and primary goal?")


def _mod(c, m):
    return F.col(c) % m


def _plan_name(prio):
    expr = None
    for p, name in PRIORITY_PLAN:
        expr = F.when(prio == p, name) if expr is None else expr.when(prio == p, name)
    return expr.otherwise("other")


class Adapters:
    def __init__(self, tables):
        self.t = tables
        self.spark = tables.spark

    # ---- members and facilities -------------------------------------------------
    @cached_property
    def members(self) -> DataFrame:
        k = F.col("c_custkey")
        two = lambda c: F.lpad(c.cast("string"), 2, "0")
        birthday = F.when(k % 9 == 0, F.lit("1990/01/02")).otherwise(
            F.concat_ws("-", two(1 + k % 31), two(1 + k % 12), (1950 + k % 65).cast("string")))
        return self.t.customer.select(
            k.alias("user_id"),
            F.col("c_name").alias("nickname"),
            F.substring_index("c_name", "#", 1).alias("firstname"),
            F.substring_index("c_name", "#", -1).alias("lastname"),
            F.when(k % 8 != 0, F.concat(F.lit("+"), F.lpad(k.cast("string"), 9, "0"))).alias("phone"),
            F.col("c_nationkey").alias("facility_id"),
            F.when(k % 13 == 0, "staff").otherwise("user").alias("role"),
            F.when(k % 17 == 0, F.lit("partner")).alias("partnership"),
            birthday.alias("birthday"),
            F.when(k % 2 == 0, "F").otherwise("M").alias("gender"),
            (50 + k % 50).cast("double").alias("weight"),
            (150 + k % 40).cast("double").alias("height"),
            F.date_add(F.lit(date(1994, 1, 1)), (k % 2500).cast("int")).alias("created_date"),
        )

    @cached_property
    def facilities(self) -> DataFrame:
        k = F.col("n_nationkey")
        has = k % 5 != 4
        return self.t.nation.select(
            k.alias("facility_id"),
            F.col("n_name").alias("name"),
            F.when(has, (432000 + 50 * k).cast("double") / 10000.0).alias("lat"),
            F.when(has, (769000 + 70 * k).cast("double") / 10000.0).alias("lon"),
        )

    @cached_property
    def facility_names(self) -> DataFrame:
        """Primary (partial: one region missing) facility-name table; ``facilities`` is the fallback."""
        return self.t.nation.filter(F.col("n_regionkey") != 3).select(
            F.col("n_nationkey").alias("facility_id"), F.col("n_name").alias("name"))

    # ---- plans, periods, freezes, trials, payments --------------------------------
    @cached_property
    def plans(self) -> DataFrame:
        """The plan dimension: a table of its own, not a DISTINCT over the periods."""
        return self.spark.createDataFrame([(p,) for p in PRIORITIES], "plan_id string").select(
            "plan_id", _plan_name(F.col("plan_id")).alias("name"))

    @cached_property
    def periods(self) -> DataFrame:
        prio = F.col("o_orderpriority")
        start = F.to_date("o_orderdate")
        days = F.when(prio.isin("1-URGENT", "2-HIGH"), 364).when(prio == "3-MEDIUM", 181).otherwise(OTHER_PLAN_DAYS)
        k = F.col("o_orderkey")
        return self.t.orders.select(
            k.alias("period_id"),
            F.col("o_custkey").alias("user_id"),
            prio.alias("plan_id"),
            F.when(k % 4 != 0, (k % 25).cast("int")).alias("facility_id"),
            start.alias("start_date"),
            F.date_add(start, days).alias("end_date"),
            F.when(k % 50 != 0, F.col("o_orderdate")).alias("created_at"),
        )

    def _order_owner(self) -> DataFrame:
        return self.t.orders.select(F.col("o_orderkey"), F.col("o_custkey").alias("user_id"))

    @cached_property
    def freezes(self) -> DataFrame:
        li = self.t.lineitem.filter(F.col("l_returnflag") == "R")
        start = F.to_date("l_shipdate")
        end = F.date_add(start, (F.floor("l_quantity").cast("int") % 14))
        return (li.join(self._order_owner(), li.l_orderkey == F.col("o_orderkey"))
                .select("user_id", F.col("l_orderkey").alias("period_id"),
                        start.alias("start_date"),
                        F.when(F.col("l_linenumber") != 7, end).alias("end_date")))

    @cached_property
    def trial_events(self) -> DataFrame:
        p = self.periods.filter(F.col("plan_id") == "5-LOW")
        pid = F.col("period_id")
        kind = F.when(pid % 3 == 0, "full_week").when(pid % 3 == 1, "intro_course").otherwise("single_visit")
        return p.select(pid.alias("event_id"), F.col("start_date").alias("trial_start"), kind.alias("trial_kind"))

    @cached_property
    def trial_attendance(self) -> DataFrame:
        """Who attended which trial event; some attend events that no table describes."""
        p = self.periods.filter(F.col("plan_id").isin("5-LOW", "4-NOT SPECIFIED"))
        return p.select(F.col("period_id").alias("event_id"), "user_id")

    @cached_property
    def payments(self) -> DataFrame:
        li = self.t.lineitem.filter(F.col("l_tax") < 0.03)
        flag = F.col("l_returnflag")
        return (li.join(self._order_owner(), li.l_orderkey == F.col("o_orderkey"))
                .select("user_id", F.col("l_orderkey").alias("event_id"),
                        F.when(F.col("l_linenumber") != 5, F.col("l_discount")).alias("amount"),
                        F.when(flag == "A", "adminAdd").when(flag == "N", "added").otherwise("card").alias("type"),
                        F.when(F.col("l_linenumber") == 1, "voucher for a week").otherwise("purchase").alias("name")))

    # ---- member activity tables ----------------------------------------------------
    def _events(self, event_type: str) -> DataFrame:
        return self.t.events.filter(F.col("event_type") == event_type)

    @cached_property
    def body_tests(self) -> DataFrame:
        e = F.col("event_id")
        return self._events("view").select(
            e.alias("test_id"), "user_id",
            F.when(e % 11 != 0, F.col("ts")).alias("tested_at"),
            F.col("value").alias("weight"),
            (150 + e % 40).cast("double").alias("height"),
            F.round(F.col("value") / 3.0, 2).alias("fat_pct"),
            F.round(F.col("value") / 2.5, 1).alias("bmi"),
        )

    @cached_property
    def measures(self) -> DataFrame:
        """Further measures of a member: assessments and lifted weights."""
        kind = F.when(F.col("event_type") == "click", "assessment").otherwise("lifted_weight")
        return self.t.events.filter(F.col("event_type").isin("click", "purchase")).select(
            F.col("event_id").alias("measure_id"), "user_id", kind.alias("kind"), F.col("ts").alias("measured_at"), "value")

    @cached_property
    def friend_counts(self) -> DataFrame:
        return self._events("signup").select(
            F.col("event_id").alias("row_id"), "user_id", F.col("ts").alias("as_of"),
            (F.col("event_id") % 40).cast("int").alias("friends"))

    @cached_property
    def posts(self) -> DataFrame:
        return self._events("click").select(
            F.col("event_id").alias("post_id"), "user_id",
            F.when(F.col("value") < 10, "draft").otherwise("posted").alias("status"))

    @cached_property
    def groups(self) -> DataFrame:
        k = F.col("s_suppkey")
        return self.t.supplier.select(
            k.alias("group_id"),
            ((k * 7) % 1500).alias("admin"),
            F.when(k % 4 != 0, F.array(3 * k, 3 * k + 1)).alias("users"),
            F.when(k % 2 != 0, F.array(5 * k)).alias("mentors"),
        )

    @cached_property
    def questions(self) -> DataFrame:
        """The questionnaire: a table of its own."""
        return self.spark.createDataFrame(list(enumerate(QUESTIONS)), "question_id int, question string")

    @cached_property
    def answers(self) -> DataFrame:
        turn, conv = F.col("turn"), F.col("conv_id")
        question = F.when(turn % 5 == 4, 3).otherwise(turn % 3).cast("int")
        created = turn * 1_000_000 + conv
        return self.t.conversations.filter(F.col("role") == "user").select(
            (conv * 1000 + turn).alias("answer_id"),
            (conv % 150).alias("user_id"),
            question.alias("question_id"),
            F.col("text").alias("answer"),
            created.alias("created_seq"),
            F.when(conv % 4 == 0, created + 500_000).alias("updated_seq"),
        )

    @cached_property
    def test_accounts(self) -> DataFrame:
        return self.t.customer.filter(F.col("c_acctbal") < 0).select(
            F.col("c_custkey").alias("user_id"),
            F.when(F.col("c_mktsegment") == "BUILDING", "internal").otherwise("other").alias("free_pass_type"))

    @cached_property
    def member_locations(self) -> DataFrame:
        u, e = F.col("user_id"), F.col("event_id")
        cell = F.when(u % 3 == 0, e % 2).when(u % 3 == 1, e % 4).otherwise(e % 9)
        lat = (432000 + 130 * (u % 5) + 37 * cell).cast("double") / 10000.0 + F.lit(0.00001) * (e % 3)
        lon = (769000 + 90 * (u % 7) + 53 * cell).cast("double") / 10000.0 + F.lit(0.00001) * (e % 2)
        # coordinates missing: error events with even id, and most rows of every tenth member
        bad = ((F.col("event_type") == "error") & (e % 2 == 0)) | ((u % 10 == 0) & (e % 40 != 0))
        return self.t.events.select(
            e.alias("point_id"), u.alias("user_id"),
            F.when(~bad, F.struct(lat.alias("latitude"), lon.alias("longitude"))).alias("location"),
            F.col("ts").alias("created_at"),
        )

    @cached_property
    def activity(self) -> DataFrame:
        return self.t.events.select(
            F.col("event_id").alias("activity_id"), "user_id", "ts", "event_type", "value",
            (F.col("event_id") % 7).alias("trainer_id"))

    @cached_property
    def usage(self) -> DataFrame:
        """Use of the app and devices: (member, time, metric, amount)."""
        kind = F.col("event_type")
        metric = (F.when(kind == "view", "time_in_app").when(kind == "click", "steps").when(kind == "signup", "assessment_frequency")
                  .when(kind == "purchase", "hrm_usage").otherwise("weight_entries"))
        amount = F.when(kind == "view", F.col("event_id") % 90).when(kind == "click", 10 * (F.col("event_id") % 997)).otherwise(1).cast("double")
        return self.t.events.select("user_id", "ts", metric.alias("metric"), amount.alias("amount"))

    @cached_property
    def member_documents(self) -> DataFrame:
        """Members as JSON texts whose fields change type from document to document."""
        k = F.col("c_custkey")
        text = lambda c: c.cast("string")
        quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
        phone = F.when(k % 3 == 0, text(k)).when(k % 3 == 1, quoted(F.concat(F.lit("+"), text(k)))).otherwise("null")
        score = F.when(k % 4 == 0, F.lit('"n/a"')).otherwise(F.concat(text(k % 11), F.lit(".5")))
        groups = F.when(k % 5 == 0, "[]").when(k % 5 == 1, F.concat(F.lit('[{"id": '), text(k), F.lit(', "role": "admin"}, {"id": '), text(k + 1), F.lit("}]"))).otherwise("null")
        whole = F.concat(F.lit('{"id": '), text(k), F.lit(', "name": '), quoted(F.col("c_name")), F.lit(', "phone": '), phone, F.lit(', "profile": {"segment": '),
                         quoted(F.col("c_mktsegment")), F.lit(', "scores": ['), text(k % 7), F.lit(", "), score, F.lit(']}, "groups": '), groups, F.lit("}"))
        doc = F.when(k % 97 == 0, F.lit(None)).when(k % 89 == 0, "{broken").otherwise(whole)
        return self.t.customer.select(k.alias("doc_key"), doc.alias("doc"))

    @cached_property
    def scores(self) -> DataFrame:
        k = F.col("c_custkey")
        return self.t.customer.select(
            k.alias("user_id"), ((k % 101).cast("double") / 100.0).alias("probability"),
            F.when(k % 3 == 0, 0).otherwise(1).alias("observed"))
