"""Confusion counts and the metrics that follow from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskflow.fixed_values import LABEL
from riskflow.functions import ratio
from riskflow.operators.ranking import running_totals


def _counts(label: Column, prediction: Column, weight: Column | None = None) -> list[Column]:
    cells = {
        "tp": (label == 1) & (prediction == 1),
        "tn": (label == 0) & (prediction == 0),
        "fp": (label == 0) & (prediction == 1),
        "fn": (label == 1) & (prediction == 0),
    }
    if weight is None:
        return [F.count_if(cell).alias(name) for name, cell in cells.items()]
    zero = F.lit(0).cast("bigint")
    return [
        F.coalesce(F.sum(F.when(cell, weight)), zero).cast("bigint").alias(name)
        for name, cell in cells.items()
    ]


def confusion(
    predictions: DataFrame,
    label: str = LABEL,
    prediction: str = "prediction",
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """tp, tn, fp and fn in one aggregate; ``weight`` counts a row that often."""
    counts = _counts(F.col(label), F.col(prediction), F.col(weight) if weight else None)
    return predictions.groupBy(*by).agg(*counts)


def metrics(counts: DataFrame, undefined: float | None = None) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class, added to confusion counts.

    ``undefined`` stands for a quotient by zero: null unless given.
    """
    tp, tn, fp, fn = (F.col(name) for name in ("tp", "tn", "fp", "fn"))
    return counts.withColumns(
        {
            "accuracy": ratio(tp + tn, tp + tn + fp + fn, undefined),
            "precision": ratio(tp, tp + fp, undefined),
            "recall": ratio(tp, tp + fn, undefined),
            "f1": ratio(2 * tp, 2 * tp + fp + fn, undefined),
        }
    )


def confusion_matrix(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts as cells (actual, predicted, n)."""
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    rows = F.array(
        *[
            F.struct(
                F.lit(actual).alias("actual"), F.lit(predicted).alias("predicted"), F.col(name).alias("n")
            )
            for actual, predicted, name in cells
        ]
    )
    return counts.select(*by, F.inline(rows))


def area_under_roc(
    predictions: DataFrame, score: str = "probability", label: str = LABEL, by: Sequence[str] = ()
) -> DataFrame:
    """The exact area under the ROC curve: (by, positives, negatives, auc).

    The share of pairs of a positive and a negative row in which the positive one has the higher score, ties being
    half a pair. Rows are counted per distinct score before they are shuffled; the negatives below a score are a
    running total, so nothing is binned and no task sorts everything. Sums are exact decimals. Rows without a score
    or a label are left out; the area is null if a class has no row.
    """
    known = predictions.filter(F.col(score).isNotNull() & F.col(label).isin(0, 1))
    counted = known.groupBy(*by, F.col(score).alias("_score")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg")
    )
    ranked = running_totals(counted, [F.asc("_score")], "_neg", by, "_below")
    exact = [F.col(c).cast("decimal(19,0)") for c in ("_pos", "_below", "_neg")]
    twice = (exact[0] * (2 * exact[1] + exact[2])).cast("decimal(38,0)")
    sums = ranked.groupBy(*by).agg(
        F.sum("_pos").alias("positives"), F.sum("_neg").alias("negatives"), F.sum(twice).alias("_twice")
    )
    pairs = 2 * F.col("positives").cast("double") * F.col("negatives")
    return sums.withColumn("auc", F.try_divide(F.col("_twice").cast("double"), pairs)).drop("_twice")


def long_metrics(measured: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Metrics as (metric, value), named for run tracking."""
    names = ["accuracy", "precision", "recall", "f1", "tp", "tn", "fp", "fn"]
    doubles = measured.select(*by, *[F.col(n).cast("double").alias(n) for n in names])
    return doubles.unpivot(list(by), names, "metric", "value")
