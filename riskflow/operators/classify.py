"""Logistic regression: fit, tune, predict, save and load with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskflow.fixed_values import (
    ELASTIC_NET_PARAM,
    GRID_ELASTIC_NET_PARAM,
    GRID_FIT_INTERCEPT,
    GRID_REG_PARAM,
    LABEL,
    MAX_ITER,
    REG_PARAM,
    TUNING_TRAIN_RATIO,
)
from riskflow.operators.encode import FEATURES, SCALED
from riskflow.operators.evaluate import confusion, metrics


def logistic(
    max_iter: int = MAX_ITER,
    reg_param: float = REG_PARAM,
    elastic_net_param: float = ELASTIC_NET_PARAM,
    features: str = SCALED,
    label: str = LABEL,
) -> LogisticRegression:
    return LogisticRegression(
        maxIter=max_iter,
        regParam=reg_param,
        elasticNetParam=elastic_net_param,
        family="binomial",
        featuresCol=features,
        labelCol=label,
    )


def parameter_grid(
    estimator: LogisticRegression,
    reg_params: Sequence[float] = GRID_REG_PARAM,
    fit_intercepts: Sequence[bool] = GRID_FIT_INTERCEPT,
    elastic_net_params: Sequence[float] = GRID_ELASTIC_NET_PARAM,
) -> list[dict]:
    return (
        ParamGridBuilder()
        .addGrid(estimator.regParam, list(reg_params))
        .addGrid(estimator.fitIntercept, list(fit_intercepts))
        .addGrid(estimator.elasticNetParam, list(elastic_net_params))
        .build()
    )


def auc_evaluator(label: str = LABEL) -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")


def tune(
    train: DataFrame,
    estimator: LogisticRegression,
    grid: list[dict],
    train_ratio: float = TUNING_TRAIN_RATIO,
    parallelism: int = 2,
    seed: int = 42,
    collect_sub_models: bool = True,
):
    """Train/validation search. The models collected on the driver are coefficient vectors."""
    search = TrainValidationSplit(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=auc_evaluator(estimator.getLabelCol()),
        trainRatio=train_ratio,
        parallelism=parallelism,
        collectSubModels=collect_sub_models,
        seed=seed,
    )
    return search.fit(train)


def cross_validate(
    train: DataFrame,
    estimator: LogisticRegression,
    grid: list[dict],
    folds: int = 3,
    parallelism: int = 2,
    seed: int = 42,
):
    """Costs ``folds`` times as many fits as ``tune``."""
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid,
        evaluator=auc_evaluator(estimator.getLabelCol()),
        numFolds=folds,
        parallelism=parallelism,
        seed=seed,
    )
    return search.fit(train)


def training_summary(spark: SparkSession, model: LogisticRegressionModel) -> DataFrame:
    summary = model.summary
    rows = [("accuracy", float(summary.accuracy)), ("areaUnderROC", float(summary.areaUnderROC))]
    return spark.createDataFrame(rows, "metric string, value double")


def parameters(spark: SparkSession, model: Model) -> DataFrame:
    """The model's parameter map as (name, value), one row per parameter."""
    rows = sorted((param.name, str(value)) for param, value in model.extractParamMap().items())
    return spark.createDataFrame(rows, "name string, value string")


def coefficients(model: PipelineModel, df: DataFrame) -> DataFrame:
    """What a saved model has learned: (name, value), a row per encoded feature and one for the intercept.

    Features are named as ``df``, rows like those it was fitted on, is encoded; only the schema of ``df`` is used.
    """
    encoded = PipelineModel(stages=model.stages[:-1]).transform(df)
    kinds = encoded.schema[FEATURES].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for attributes in kinds.values() for a in attributes}
    fitted = model.stages[-1]
    rows = [(names[i], float(value)) for i, value in enumerate(fitted.coefficients.toArray())]
    return df.sparkSession.createDataFrame([*rows, ("intercept", float(fitted.intercept))], "name string, value double")


def search_results(spark: SparkSession, fitted, grid: list[dict]) -> DataFrame:
    """One row per grid point: its parameters, validation AUC and whether it was chosen."""
    scores = getattr(fitted, "validationMetrics", None) or fitted.avgMetrics
    best = max(range(len(scores)), key=scores.__getitem__)
    rows = []
    for i, (point, score) in enumerate(zip(grid, scores)):
        named = {param.name: value for param, value in point.items()}
        rows.append(
            (
                float(named["regParam"]),
                bool(named["fitIntercept"]),
                float(named["elasticNetParam"]),
                float(score),
                i == best,
            )
        )
    return spark.createDataFrame(
        rows,
        "reg_param double, fit_intercept boolean, elastic_net_param double, auc double, chosen boolean",
    )


def predict(model: Model, df: DataFrame, keep: Sequence[str], label: str = LABEL) -> DataFrame:
    """Ids, label, prediction and probability of the positive class."""
    positive = vector_to_array(F.col("probability"))[1]
    return model.transform(df).select(*keep, label, "prediction", positive.alias("probability"))


def evaluate(predictions: DataFrame, label: str = LABEL) -> DataFrame:
    """Confusion counts and metrics in one row; a metric with nothing to divide by is zero."""
    return metrics(confusion(predictions, label), undefined=0.0)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
