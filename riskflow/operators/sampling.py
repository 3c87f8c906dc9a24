"""Class balance, splits and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskflow.fixed_values import BOOTSTRAP_RATE, LABEL, SPLIT_WEIGHTS
from riskflow.functions import hash_slice, poisson_drawn, poisson_weight, split_index
from riskflow.functions.hashing import digest

COPY = "copy_no"


def class_balance(df: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: rows per class and the whole-number ratio, null when there is no positive row."""
    negatives, positives = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    return df.agg(
        negatives.alias("n_negative"),
        positives.alias("n_positive"),
        F.floor(F.try_divide(negatives, positives)).cast("bigint").alias("ratio"),
    )


def _copies(balance: DataFrame) -> Column:
    message = F.lit("cannot balance: no row of the positive class")
    ratio = F.when(F.col("n_positive") > 0, F.greatest(F.col("ratio"), F.lit(1)))
    return balance.select(ratio.otherwise(F.raise_error(message)).cast("int")).scalar()


def oversample(df: DataFrame, label: str = LABEL, copies: int | None = None) -> DataFrame:
    """Repeat every positive row so that classes are about equal; ``copy_no`` counts from 1.

    Pass ``copies`` where the classes have been counted already.

    The ratio is a scalar subquery: one narrow pass over the label column, one over the rows, no shuffle
    of rows and no union. Negative rows stay once, rows of neither class are dropped. When negatives are
    fewer than positives the rows stay as they are.
    """
    number = F.lit(copies) if copies else _copies(class_balance(df, label))
    times = F.when(F.col(label) == 1, number).otherwise(F.lit(1))
    return df.filter(F.col(label).isin(0, 1)).withColumn(COPY, F.explode(F.sequence(F.lit(1), times)))


def oversample_by_union(df: DataFrame, label: str = LABEL) -> DataFrame:
    """The same rows as two parts put together by name. Reads the input once more than ``oversample``."""
    copies = _copies(class_balance(df, label))
    positives = df.filter(F.col(label) == 1)
    repeated = positives.withColumn(COPY, F.explode(F.sequence(F.lit(1), copies)))
    return df.filter(F.col(label) == 0).withColumn(COPY, F.lit(1)).unionByName(repeated)


def with_split(
    df: DataFrame,
    id_columns: Sequence[str],
    weights: Sequence[float] = SPLIT_WEIGHTS,
    salt: str = "",
    name: str = "split",
) -> DataFrame:
    """Number of the split as column ``name``; a row keeps its split in every run."""
    return df.withColumn(name, split_index([F.col(c) for c in id_columns], weights, salt))


def hash_split(
    df: DataFrame, id_columns: Sequence[str], weights: Sequence[float] = SPLIT_WEIGHTS, salt: str = ""
) -> list[DataFrame]:
    """Disjoint parts by hash of ids: no sort, no shuffle, and stable when a lost part is computed again."""
    part = split_index([F.col(c) for c in id_columns], weights, salt)
    return [df.filter(part == i) for i in range(len(weights))]


def random_split(df: DataFrame, weights: Sequence[float] = SPLIT_WEIGHTS, seed: int = 42) -> list[DataFrame]:
    """Spark's own split. It sorts every partition; ``hash_split`` does not need to."""
    return df.randomSplit(list(weights), seed)


def hash_sample(
    df: DataFrame, id_columns: Sequence[str], rate: float = BOOTSTRAP_RATE, salt: str = ""
) -> DataFrame:
    """A sample with replacement that every run repeats: each row as often as a Poisson draw from its ids says."""
    draw = hash_slice(digest([F.col(c) for c in id_columns], salt), 0)
    copies = F.sequence(F.lit(1), poisson_weight(draw, rate))
    return df.filter(poisson_drawn(draw, rate)).withColumn(COPY, F.explode(copies))


def sample_with_replacement(df: DataFrame, fraction: float = BOOTSTRAP_RATE, seed: int = 42) -> DataFrame:
    return df.sample(True, fraction, seed)
