import math

from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF001


def test_baseline_training_and_batch_score(spark):
    q = E.queries()
    coef = {r.feature: r.coefficient for r in q["train_baseline"](spark, SF001).collect()}
    assert set(coef) == {"length_days", "freeze_days", "start_month", "intercept"}
    assert all(math.isfinite(v) for v in coef.values())
    scored = q["batch_score"](spark, SF001)
    bad = scored.filter((F.col("probability") < 0) | (F.col("probability") > 1)).count()
    assert bad == 0 and scored.count() > 0
    bands = scored.filter(
        ((F.col("probability") < 0.3) & (F.col("risk_band") != "very_high"))
        | ((F.col("probability") >= 0.85) & (F.col("risk_band") != "very_low"))).count()
    assert bands == 0


def test_survival_and_trees(spark):
    q = E.queries()
    surv = {r.feature: r.coefficient for r in q["train_survival"](spark, SF001).collect()}
    assert set(surv) == {"week_index", "intercept"}
    imp = q["train_trees"](spark, SF001).collect()
    assert len(imp) == 3 and abs(sum(r.importance for r in imp) - 1.0) < 1e-6 or sum(r.importance for r in imp) == 0


def test_scores_are_the_saved_coefficients_on_the_features(spark):
    """What SQL would compute from the coefficients in the row."""
    import duckdb

    q = E.queries()
    coef = {r.feature: r.coefficient for r in q["train_baseline"](spark, SF001).collect()}
    scores = q["batch_score"](spark, SF001).toPandas()  # noqa: F841 - read by DuckDB
    from renewlens.plans.catalog import tables_for
    from renewlens.plans.q_declared import _period_features

    rows = _period_features(tables_for(spark, SF001)).toPandas()  # noqa: F841 - read by DuckDB
    off = duckdb.sql(f"""select count(*), max(abs(probability - 1 / (1 + exp(-({coef['intercept']} + {coef['length_days']} * length_days
                         + {coef['freeze_days']} * freeze_days + {coef['start_month']} * start_month))))) from rows join scores using (period_id)""").fetchall()[0]
    assert off[0] == len(rows) == len(scores) and off[1] < 1e-9


def test_best_round_and_patience():
    from renewlens.operators.scoring import best_round

    assert best_round([3, 2, 1, 2, 2, 2], 3) == (3, True)
    assert best_round([3, 2, 1, 2, 2], 3) == (3, False)
    assert best_round([3, 2, 2.5, 2.5, 1, 4, 4, 4], 3) == (5, True)
    assert best_round([3, 2, 2.5, 2.5, 2.5, 1], 3) == (2, True)    # a later minimum is beyond the patience
    assert best_round([1], 3) == (1, False)


def test_trees_keep_the_best_prefix(spark):
    """Labels that the validation part contradicts: more rounds fit them better and lose on it."""
    from pyspark.ml.classification import GBTClassifier

    from renewlens.operators import scoring as S

    df = (spark.range(600).withColumn("x", F.col("id") % 37).withColumn("y", F.xxhash64("id") % 11)
          .withColumn("label", (F.pmod(F.xxhash64(F.lit(3), "id"), F.lit(5)) < F.when(F.col("x") < 18, 3).otherwise(2))))
    df = df.select("id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), "label")
    model, losses = S.train_trees(df, ["x", "y"], max_depth=3, step_size=0.5, max_iter=40, patience=5, key="id")
    best, settled = S.best_round(losses, 5)
    assert settled and model.getNumTrees == best < len(losses) and losses[best - 1] == min(losses[: best + 5])
    # fewer rounds are a prefix of more
    data = S.assemble(df, ["x", "y"]).select("features", F.col("label").cast("double").alias("label"))
    few, more = (GBTClassifier(maxIter=n, maxDepth=3, stepSize=0.5, seed=7).fit(data) for n in (3, 6))
    assert few.evaluateEachIteration(data) == more.evaluateEachIteration(data)[:3]


def test_models_are_loaded_by_version(spark, tmp_path):
    import pytest
    from pyspark.ml.classification import LogisticRegressionModel

    from renewlens.operators import scoring as S

    df = spark.range(100).select("id", (F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 10 > F.col("id") % 7).alias("label"))
    path = f"file://{tmp_path}/m"
    models = [S.train_survival(df.withColumnRenamed("label", "event"), ["x"], reg=r) for r in (0.1, 0.5)]
    for v, m in zip(("20240101_000000", "20240201_000000"), models):
        S.save_model(m, path, v)
    assert S.load_model(spark, path, LogisticRegressionModel).coefficients == models[1].coefficients
    assert S.load_model(spark, path, LogisticRegressionModel, "20240101_000000").coefficients == models[0].coefficients
    with pytest.raises(Exception):
        S.save_model(models[0], path, "20240101_000000")


def _repeated(spark):
    """Rows of which many are equal."""
    i = F.col("id")
    return spark.range(900).select("id", (i % 5).cast("double").alias("x"), (F.pmod(F.xxhash64("id"), F.lit(3)) * 2).cast("double").alias("y"),
                                   (F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(7)) < i % 5).alias("label"))


def test_equal_rows_are_fitted_as_one(spark, monkeypatch):
    """Fits see each combination once, weighted, and give what all rows give, penalty included."""
    from pyspark.ml.classification import GBTClassifier, LogisticRegression

    from renewlens.operators import scoring as S

    df, sizes, real = _repeated(spark), [], S.equal_rows

    def counted(*args, **others):
        out = real(*args, **others)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(S, "equal_rows", counted)
    plain = S.assemble(df, ["x", "y"]).select("features", F.col("label").cast("double").alias("label"))
    for reg in (0.0, 0.1):
        rows = LogisticRegression(regParam=reg, maxIter=200, tol=1e-8).fit(plain)
        ours = S.train_survival(df.withColumnRenamed("label", "event"), ["x", "y"], reg=reg)
        assert max(abs(a - b) for a, b in zip([*rows.coefficients, rows.intercept], [*ours.coefficients, ours.intercept])) < 1e-6
        assert ours.getRegParam() == reg and abs(ours.coefficients[0]) > 0.1
        assert all(abs(g) < 1e-6 for g in S.logistic_gradient(ours, df, ["x", "y"], "label", reg).values())
    trees, losses = S.train_trees(df, ["x", "y"], max_depth=3, max_iter=4, patience=2, key="id")
    val = F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(1000)) < 200
    part = lambda c: S.assemble(df.filter(c), ["x", "y"]).select("features", F.col("label").cast("double").alias("label"))
    other = GBTClassifier(maxDepth=3, stepSize=0.01, maxIter=4, seed=7).fit(part(~val))
    assert all(abs(a - b) < 1e-9 for a, b in zip(losses, other.evaluateEachIteration(part(val))))
    assert len(sizes) == 5 and max(sizes) <= 15 * 2 * 2


def test_saved_model_keeps_its_penalty(spark, tmp_path):
    from pyspark.ml.classification import LogisticRegressionModel

    from renewlens.operators import scoring as S

    S.save_model(S.train_survival(_repeated(spark).withColumnRenamed("label", "event"), ["x"], reg=0.25), f"file://{tmp_path}/m", "1")
    assert S.load_model(spark, f"file://{tmp_path}/m", LogisticRegressionModel).getRegParam() == 0.25


def test_unsettled_trees_are_fitted_twice_at_most_before_the_prefix(spark, monkeypatch):
    from pyspark.ml.classification import GBTClassifier

    from renewlens.operators import scoring as S

    rounds, real = [], GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, *a: rounds.append(self.getMaxIter()) or real(self, *a))
    monkeypatch.setattr(S, "best_round", lambda losses, patience: (len(losses), False))
    model, losses = S.train_trees(_repeated(spark), ["x", "y"], max_depth=2, max_iter=9, patience=1, key="id")
    assert rounds == [2, 9] and model.getNumTrees == len(losses) == 9
