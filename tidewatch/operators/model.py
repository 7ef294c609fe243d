"""Spark ML estimators, scoring and drivers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from tidewatch.config import ANCHOR_KEYS
from tidewatch.operators import compiled
from tidewatch.operators.boosting import BoostedTrees
from tidewatch.sources import numeric_columns

# Columns of the model table that are never features.
NOT_FEATURES = ("label", "weight", *ANCHOR_KEYS, "anchor_date", "deterioration_time", "split")


def feature_columns(df: DataFrame, exclude: Sequence[str] = NOT_FEATURES) -> list[str]:
    return sorted(numeric_columns(df, exclude))


def _assembled(features: Sequence[str], estimator) -> Pipeline:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    return Pipeline(stages=[assembler, estimator])


def logreg_pipeline(
    features: Sequence[str],
    label: str = "label",
    weight: str | None = "weight",
    max_iter: int = 50,
    reg_param: float = 0.01,
    elastic_net: float = 0.0,
) -> Pipeline:
    lr = LogisticRegression(
        featuresCol="features", labelCol=label, maxIter=max_iter, regParam=reg_param, elasticNetParam=elastic_net
    )
    return _assembled(features, lr if weight is None else lr.setWeightCol(weight))


def gbt_pipeline(
    features: Sequence[str],
    label: str = "label",
    weight: str | None = None,
    max_iter: int = 60,
    max_depth: int = 5,
    step_size: float = 0.1,
    subsampling: float = 0.8,
    seed: int = 42,
) -> Pipeline:
    gbt = BoostedTrees(
        featuresCol="features",
        labelCol=label,
        maxIter=max_iter,
        maxDepth=max_depth,
        stepSize=step_size,
        subsamplingRate=subsampling,
        seed=seed,
    )
    return _assembled(features, gbt if weight is None else gbt.setWeightCol(weight))


def fit_and_save(pipeline: Pipeline, train: DataFrame, path: str) -> PipelineModel:
    """Fit, save to ``path`` and return the model as loaded from there, without its training summary."""
    save_model(pipeline.fit(train), path)
    return load_model(path)


def score(df: DataFrame, model: PipelineModel, keep: Sequence[str], out: str = "risk_score") -> DataFrame:
    """Probability of the positive class next to the kept columns.

    The model is compiled to a column expression, so a fitted and a loaded one score alike. A null
    feature gives a null score.
    """
    return compiled.score_with(df, compiled.compiled(model), keep, out)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def logreg_slopes(
    train: DataFrame, model: PipelineModel, features: Sequence[str], label: str = "label", weight: str = "weight"
) -> DataFrame:
    """Derivative of the fitted loss by each standardised coefficient: near zero at the optimum.

    The loss is the weighted mean of the logistic losses plus half of ``regParam`` times the squares
    of the coefficients times the deviations, for fits without an L1 part. One row (feature, slope,
    rows) per feature and one named ``(intercept)``; all of it is one aggregation.
    """
    last = model.stages[-1]
    reg, coefficients = last.getRegParam(), last.coefficients.toArray()
    scored = score(train, model, [*features, label, weight], "__p")
    w = F.col(weight).cast("double")
    error = w * (F.col("__p") - F.col(label).cast("double"))
    total = F.sum(w)
    parts = [F.struct(F.lit("(intercept)").alias("feature"), (F.sum(error) / total).alias("slope"))]
    for f, c in zip(features, coefficients):
        x = F.col(f).cast("double")
        # Deviation with weights as frequencies, as the fit standardises by it.
        variance = (F.sum(w * x * x) - F.sum(w * x) * F.sum(w * x) / total) / (total - F.sum(w * w) / total)
        std = F.sqrt(F.greatest(variance, F.lit(0.0)))
        slope = F.when(std > 0, F.sum(error * x) / total / std + F.lit(float(reg * c)) * std)
        parts.append(F.struct(F.lit(f).alias("feature"), slope.alias("slope")))
    one = scored.agg(F.count(F.lit(1)).alias("rows"), F.array(*parts).alias("parts"))
    return one.select("rows", F.explode("parts").alias("p")).select("p.feature", "p.slope", "rows")


def model_weights(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Coefficients of a linear model, or importances of a tree model, one row per feature."""
    from pyspark.sql import SparkSession

    last = model.stages[-1]
    values = last.coefficients if hasattr(last, "coefficients") else last.featureImportances
    rows = [(f, float(v)) for f, v in zip(features, values.toArray())]
    return SparkSession.active().createDataFrame(rows, "feature string, weight double")


def top_drivers(
    df: DataFrame,
    model: PipelineModel | compiled.LinearForm | compiled.Forest,
    features: Sequence[str] = (),
    keep: Sequence[str] = ANCHOR_KEYS,
    n: int = 3,
) -> DataFrame:
    """The ``n`` features that raise each row's score most, for linear models and forests alike.

    A linear model's feature contributes its coefficient times its distance from the mean of ``df``, a
    forest's the changes of prediction along the paths at the steps that ask for it. Equal
    contributions go by the feature's name, backwards. Ordered within the row, without a shuffle.
    A row with a null feature has null contributions, which come last.
    """
    form = compiled.compiled(model) if isinstance(model, PipelineModel) else model
    found = compiled.attributed(df, form, keep)
    ordered = F.slice(F.sort_array(F.transform("contributions", lambda c: F.struct(c["contribution"], c["feature"])), asc=False), 1, n)
    return found.select(*keep, F.transform(ordered, lambda d: d["feature"]).alias("top_drivers"))
