"""Questionnaire answers -> labels, all question classes in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renewlens.config import AnswerRules
from renewlens.operators.ranking import latest_by


def tag_question_classes(answers: DataFrame, rules: Sequence[AnswerRules], question_col: str = "question") -> DataFrame:
    """One row per (answer, matching class); a question matching two classes gives two rows."""
    q = F.lower(F.col(question_col))
    tags = F.array(*[F.when(q.rlike(r.question_pattern), F.lit(r.name)) for r in rules])
    # explode + null filter (stays in whole-stage codegen, unlike a lambda filter)
    return answers.withColumn("qclass", F.explode(tags)).filter(F.col("qclass").isNotNull())


def label_expr(rules: Sequence[AnswerRules], answer_col: str = "answer"):
    """Ordered, case-insensitive (Unicode-aware) answer patterns per class; first match wins."""
    a = F.col(answer_col)
    expr = None
    for r in rules:
        for pattern, label in r.labels:
            cond = (F.col("qclass") == r.name) & a.rlike(f"(?iu){pattern}")
            expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def latest_answers(answers: DataFrame, rules: Sequence[AnswerRules], key: str = "user_id",
                   order=None, tie: str = "answer_id") -> DataFrame:
    """Latest answer per (member, class) by ``order`` desc nulls last, then label it."""
    order = order if order is not None else F.coalesce(F.col("updated_seq"), F.col("created_seq"))
    tagged = tag_question_classes(answers, rules)
    latest = latest_by(tagged, [key, "qclass"], [order], [F.col(tie)], payload=[tie, "answer"])
    return latest.withColumn("label", label_expr(rules))


def answer_classify(answers: DataFrame, rules: Sequence[AnswerRules], key: str = "user_id") -> DataFrame:
    """One row per member with one label column per class."""
    latest = latest_answers(answers, rules, key)
    return latest.groupBy(key).agg(*[F.max(F.when(F.col("qclass") == r.name, F.col("label"))).alias(r.name)
                                     for r in rules])
