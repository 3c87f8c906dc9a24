"""Compare classifiers: bootstrap replicates, bands, densities, histograms, t-test and intervals.

One job computes all replicates of all models. Each row draws its own weights from a hash of its id, so a
replicate is a sum of weights and no sample is ever stored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskflow.fixed_values import (
    BOOTSTRAP_RATE,
    BOOTSTRAP_REPLICATES,
    DENSITY_POINTS,
    INTERVAL_CONFIDENCE,
    LABEL,
    TEST_ALPHA,
)
from riskflow.functions import hash_slice, poisson_drawn, poisson_weight, ratio, t_critical, two_sided_p
from riskflow.functions.hashing import SLICES_PER_DIGEST, digest
from riskflow.operators.evaluate import confusion, metrics

METRICS = ("f1", "precision", "recall", "accuracy")


def replicate_counts(
    predictions: DataFrame,
    id_columns: Sequence[str],
    replicates: int = BOOTSTRAP_REPLICATES,
    rate: float = BOOTSTRAP_RATE,
    model: str = "model",
    label: str = LABEL,
) -> DataFrame:
    """Confusion counts per model and replicate of a Poisson bootstrap.

    A digest yields several draws, so a row is hashed once per ``SLICES_PER_DIGEST`` replicates. Rows of
    weight zero, most of them at a small rate, are gone before the aggregate, and what is shuffled is
    four numbers per model, replicate and task. A replicate that draws no row has zero counts.
    """
    digests = math.ceil(replicates / SLICES_PER_DIGEST)
    ids = [F.col(c) for c in id_columns]
    weighted = (
        predictions.select(model, label, "prediction", *id_columns)
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(digests - 1))))
        .withColumn("digest", digest([F.col(model), *ids], F.col("block")))
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES_PER_DIGEST - 1))))
        .withColumn("replicate", F.col("block") * SLICES_PER_DIGEST + F.col("slice"))
        .filter(F.col("replicate") < replicates)
        .withColumn("draw", hash_slice(F.col("digest"), F.col("slice")))
        .filter(poisson_drawn(F.col("draw"), rate))
        .withColumn("weight", poisson_weight(F.col("draw"), rate))
    )
    drawn = confusion(weighted, label, by=(model, "replicate"), weight="weight")
    every = predictions.select(F.col(model)).distinct().select(
        F.col(model).alias("_model"), F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("_replicate")
    )
    same = F.col("_model").eqNullSafe(F.col(model)) & (F.col("_replicate") == F.col("replicate"))
    return every.join(drawn, same, "left").select(
        F.col("_model").alias(model),
        F.col("_replicate").alias("replicate"),
        *[F.coalesce(n, F.lit(0).cast("bigint")).alias(n) for n in ("tp", "tn", "fp", "fn")],
    )


def replicate_metrics(counts: DataFrame) -> DataFrame:
    return metrics(counts, undefined=0.0)


def long_scores(replicates: DataFrame, model: str = "model", names: Sequence[str] = METRICS) -> DataFrame:
    """Replicates as (model, replicate, metric, value)."""
    return replicates.select(model, "replicate", *names).unpivot(
        [model, "replicate"], list(names), "metric", "value"
    )


def moments(scores: DataFrame, by: Sequence[str] = ("model", "metric")) -> DataFrame:
    return scores.groupBy(*by).agg(
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.count("value").alias("n"),
    )


def sigma_bands(measured: DataFrame) -> DataFrame:
    """Mean with one and three standard deviations on either side."""
    mean, std = F.col("mean"), F.col("std")
    return measured.withColumns(
        {
            "low_3": mean - 3 * std,
            "low_1": mean - std,
            "high_1": mean + std,
            "high_3": mean + 3 * std,
        }
    )


def density(measured: DataFrame, points: int = DENSITY_POINTS) -> DataFrame:
    """Normal density on evenly spaced points between minus and plus three standard deviations."""
    mean, std = F.col("mean"), F.col("std")
    step = F.col("point") / F.lit(float(points - 1))
    z = F.lit(-3.0) + 6.0 * step
    return (
        measured.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .withColumn("x", mean + z * std)
        .withColumn("y", F.try_divide(F.exp(z * z * -0.5), std * math.sqrt(2 * math.pi)))
        .drop("mean", "std", "n")
    )


def histogram(scores: DataFrame, bins: int = 10, by: Sequence[str] = ("model", "metric")) -> DataFrame:
    """Values per equal-width bin between a group's smallest and largest value.

    A group holds one value per replicate, a number the caller sets, so the window stays small. The last
    bin includes the largest value; a group of equal values fills the first bin.
    """
    group = Window.partitionBy(*by)
    position = F.floor(ratio(F.col("value") - F.col("low"), F.col("high") - F.col("low"), 0.0) * bins)
    return (
        scores.withColumns({"low": F.min("value").over(group), "high": F.max("value").over(group)})
        .withColumn("bin", F.least(position, F.lit(bins - 1)).cast("int"))
        .groupBy(*by, "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _of(value: str, column: str, model: str) -> Column:
    return F.max(F.when(F.col(model) == value, F.col(column)))


def two_sample_test(
    measured: DataFrame,
    first: str,
    second: str,
    metric: str = "f1",
    alpha: float = TEST_ALPHA,
    model: str = "model",
) -> DataFrame:
    """Two-sample t-test with equal variances between two models' replicates.

    One row: (metric, t, dof, p_value, reject). t and p are null when neither model varies.
    """
    sides = {
        f"{name}_{side}": _of(value, name, model)
        for side, value in (("a", first), ("b", second))
        for name in ("mean", "std", "n")
    }
    wide = (
        measured.filter(F.col("metric") == metric)
        .groupBy("metric")
        .agg(*[value.alias(name) for name, value in sides.items()])
    )
    n_a, n_b = F.col("n_a"), F.col("n_b")
    dof = (n_a + n_b - 2).cast("int")
    spread = (n_a - 1) * F.col("std_a") * F.col("std_a") + (n_b - 1) * F.col("std_b") * F.col("std_b")
    error = F.sqrt(ratio(spread, dof) * (ratio(F.lit(1), n_a) + ratio(F.lit(1), n_b)))
    return (
        wide.withColumn("dof", dof)
        .withColumn("t", F.try_divide(F.col("mean_a") - F.col("mean_b"), error))
        .withColumn("p_value", two_sided_p(F.col("t"), F.col("dof")))
        .select("metric", "t", "dof", "p_value", (F.col("p_value") < alpha).alias("reject"))
    )


def mean_interval(
    measured: DataFrame,
    replicates: int = BOOTSTRAP_REPLICATES,
    confidence: float = INTERVAL_CONFIDENCE,
    metric: str = "f1",
    model: str = "model",
) -> DataFrame:
    """t-interval of each model's mean: (model, metric, low, mean, high).

    It rests on as many values as were measured; ``replicates`` is the largest number that can have been, and a
    mean of more values is refused. Fewer than two values give no bounds.
    """
    points = F.array(*[F.lit(t_critical(confidence, dof)) for dof in range(1, replicates)])
    many = F.concat(F.lit(f"more than {replicates} values: "), F.col("n").cast("string"))
    point = F.when(F.col("n") > replicates, F.raise_error(many)).otherwise(F.get(points, F.col("n").cast("int") - 2))
    half = F.col("std") / F.sqrt("n") * point
    mean = F.col("mean")
    return measured.filter(F.col("metric") == metric).select(
        model, "metric", (mean - half).alias("low"), "mean", (mean + half).alias("high")
    )


def summary(predictions: DataFrame, model: str = "model", label: str = LABEL) -> DataFrame:
    """Counts and metrics of every model on the same test rows, side by side."""
    return metrics(confusion(predictions, label, by=(model,)), undefined=0.0)
