"""Risk bands and model training / batch scoring with MLlib."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewlens import config
from renewlens.functions.bands import band_below
from renewlens.sources.sinks import store


def risk_band(p) -> F.Column:
    """Left-closed retention-probability bands; p >= .85 (incl. 1) is very_low."""
    return band_below(p, config.RISK_BANDS, config.RISK_BAND_ELSE)


def intervention_level(p) -> F.Column:
    col = F.col(p) if isinstance(p, str) else p
    expr = F.when(col.isNull(), F.lit(None))
    for edge, label in config.INTERVENTION_LEVELS:
        expr = expr.when(col < edge, label)
    return expr.otherwise("none")


def band_summary(scores: DataFrame, p: str = "probability") -> DataFrame:
    return (scores.withColumn("risk_band", risk_band(p)).groupBy("risk_band")
            .agg(F.count(F.lit(1)).alias("members"), F.avg(p).alias("mean_probability")))


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


COUNT = "n_rows"


def equal_rows(df: DataFrame, features: Sequence[str], **others: Column) -> DataFrame:
    """Each combination of ``features`` and ``others`` once, stored, with how many rows have it (``n_rows``).

    A fit weighted by that number is the fit of all rows, and its passes grow with the combinations alone: features that
    are whole days, weeks or months have few, however many rows there are.
    """
    counted = df.groupBy(*features, *(c.alias(name) for name, c in others.items())).agg(F.count("*").cast("double").alias(COUNT))
    return store(counted, "equal_rows")


def counted_logistic(**params):
    """Logistic regression on ``equal_rows`` as on the rows themselves."""
    from pyspark.ml.classification import LogisticRegression

    class Counted(LogisticRegression):
        """MLlib takes weights for reliabilities: its variances, to which the penalty refers, have the divisor
        ``n - sum(w^2) / n`` where that of n rows is ``n - 1``.  Their ratio is the same for all features, so the
        penalty takes it up."""

        def _fit(self, dataset):
            n, squares = dataset.agg(F.sum(COUNT), F.sum(F.col(COUNT) * F.col(COUNT))).first()
            reg = self.getRegParam()
            share = (n - squares / n) / (n - 1) if n and n > 1 else 1.0
            return LogisticRegression._fit(self.copy({self.regParam: reg * share}), dataset)._set(regParam=reg)

    return Counted(featuresCol="features", labelCol="label", weightCol=COUNT, **params)


def train_baseline(df: DataFrame, features: Sequence[str], label: str = "label", folds: int = 5, seed: int = 7,
                   key: str = "period_id", max_iter: int = 200):
    """Logistic regression with k-fold cross-validation over the regularisation grid.

    A row's fold is a hash of its ``key``, so it stays in it when a task is repeated.  Equal rows of a fold are fitted
    and evaluated as one, weighted by their number.
    """
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    fold = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(folds)).cast("int").alias("fold")
    data = assemble(equal_rows(df, features, label=F.col(label).cast("double"), fold=fold), features).select("features", "label", "fold", COUNT)
    lr = counted_logistic(maxIter=max_iter, tol=1e-8)
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.0, 0.1]).build()
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(weightCol=COUNT),
                        numFolds=folds, foldCol="fold", seed=seed, parallelism=4)
    return cv.fit(data).bestModel


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """How many rounds of an ensemble to keep, and whether that is settled: the first round with the least loss before
    ``patience`` rounds in a row bring none lower.  Not settled if the losses end before that."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def train_trees(df: DataFrame, features: Sequence[str], label: str = "label", max_depth: int = 6,
                step_size: float = 0.01, max_iter: int = 500, validation_fraction: float = 0.2, seed: int = 7,
                key: str = "period_id", patience: int = 50):
    """Gradient-boosted trees, as many rounds as the validation part asks for: (model, losses by round).

    The validation part (a hash of ``key``) is never fitted on; equal rows of a part are one, weighted by their number.
    After a fit its loss is taken after each round; if ``patience`` rounds in a row without a lower loss are not among the
    first ``2 * patience``, all ``max_iter`` rounds are fitted.  The model is the prefix of the ensemble with the least loss, fitted anew with that many
    rounds: rounds depend on those before them alone.  Without validation rows all rounds are kept.
    """
    from pyspark.ml.classification import GBTClassifier

    held = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1000)) < validation_fraction * 1000
    data = assemble(equal_rows(df, features, label=F.col(label).cast("double"), is_val=held), features).select("features", "label", "is_val", COUNT)
    fitted, checked = data.filter("not is_val").drop("is_val"), data.filter("is_val").drop("is_val")

    def fit(rounds: int):
        return GBTClassifier(featuresCol="features", labelCol="label", weightCol=COUNT, maxDepth=max_depth, stepSize=step_size, maxIter=rounds, seed=seed,
                             maxMemoryInMB=512, cacheNodeIds=True, checkpointInterval=20).fit(fitted)

    if checked.isEmpty():
        return fit(max_iter), []
    rounds = min(max_iter, 2 * patience)
    while True:
        model = fit(rounds)
        losses = model.evaluateEachIteration(checked)
        best, settled = best_round(losses, patience)
        if settled or rounds == max_iter:
            break
        rounds = max_iter
    return (model if best == rounds else fit(best)), losses


def save_model(model, path: str, version: str) -> None:
    """Save a fitted model under a version (written once) and publish the version."""
    from pyspark.sql import SparkSession

    model.write().save(f"{path}/version={version}")
    done = SparkSession.active().createDataFrame([(version,)], "version string").coalesce(1)
    done.write.mode("append").parquet(f"{path}/_versions")


def load_model(spark, path: str, kind, version: str | None = None):
    """The model of ``kind`` (a model class of MLlib) saved under ``version``, or the newest one completed."""
    if version is None:
        version = spark.read.schema("version string").parquet(f"{path}/_versions").agg(F.max("version")).first()[0]
        if version is None:
            raise ValueError(f"no model under {path}")
    return kind.load(f"{path}/version={version}")


def feature_importance(model, features: Sequence[str], spark) -> DataFrame:
    imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")


def logistic_gradient(model, df: DataFrame, features: Sequence[str], label: str, reg: float) -> dict[str, float]:
    """Gradient of the fitted objective (mean log loss and the penalty on standardised coefficients), per coefficient:
    all zero at the optimum, and only there.  Equal rows are scored once."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(assemble(equal_rows(df, features, label=F.col(label).cast("double")), features))
    off = vector_to_array(F.col("probability"))[1] - F.col("label")
    n = F.col(COUNT)

    def mean(c):
        return F.sum(n * c) / F.sum(F.when(c.isNotNull(), n))

    row = scored.agg(mean(off).alias("intercept"), *(mean(off * F.col(f)).alias(f"g_{f}") for f in features),
                     *(mean(F.col(f)).alias(f"m_{f}") for f in features)).first()
    spread = scored.agg(*((F.sum(n * F.pow(F.col(f) - F.lit(row[f"m_{f}"]), 2)) / (F.sum(F.when(F.col(f).isNotNull(), n)) - 1)).alias(f"v_{f}")
                          for f in features)).first()
    out = {f: row[f"g_{f}"] + reg * float(c) * spread[f"v_{f}"] for f, c in zip(features, model.coefficients)}
    return out | {"intercept": row["intercept"]}


def survival_training_frame(intervals: DataFrame) -> DataFrame:
    """Pooled discrete-time hazard rows: one row per (period, week), event at the last week."""
    return intervals.withColumn("label", F.col("event").cast("double"))


def train_survival(intervals: DataFrame, features: Sequence[str], reg: float = 0.1, max_iter: int = 200):
    """Pooled logistic hazard (discrete-time survival) with L2 penalty ``reg``; Cox PH is not in MLlib."""
    data = assemble(equal_rows(survival_training_frame(intervals), features, label=F.col("label")), features)
    return counted_logistic(regParam=reg, maxIter=max_iter, tol=1e-8).fit(data)


def train_aft(spells: DataFrame, features: Sequence[str], duration: str, event: str, max_iter: int = 200):
    """Weibull accelerated-failure-time regression; ``event`` is false for censored rows."""
    from pyspark.ml.regression import AFTSurvivalRegression

    data = assemble(spells, features).select("features", F.col(duration).cast("double").alias("label"),
                                             F.col(event).cast("double").alias("censor"))
    return AFTSurvivalRegression(maxIter=max_iter, tol=1e-8).fit(data)


def write_scores(scores: DataFrame, path: str) -> None:
    """Write scores partitioned by their date; a rerun replaces that date alone."""
    (scores.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("score_date").parquet(path))


def batch_score(model, df: DataFrame, features: Sequence[str], key: str, as_of: date) -> DataFrame:
    """Score rows with a fitted classifier; probability of the positive class, band, score date."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(assemble(df, features))
    p = vector_to_array(F.col("probability"))[1]
    return scored.select(F.col(key), p.alias("probability"), risk_band(p).alias("risk_band"),
                         F.lit(as_of).alias("score_date"))
