"""Feature vectors with Spark ML stages."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F, types as T

from riskflow.fixed_values import CATEGORICAL_FEATURES, LABEL, NUMERIC_FEATURES
from riskflow.operators.joins import attach_list
from riskflow.operators.ranking import running_totals

FEATURES = "features"
SCALED = "scaledFeatures"


def check_categories(
    df: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES, limit: int | None = None
) -> None:
    """With a limit, fail before fitting when a column has more values: an indexer keeps its labels on the driver.

    The count is exact and runs before rows are multiplied. Without a limit nothing is counted.
    """
    if limit is None:
        return
    counts = df.agg(*[F.count_distinct(c).alias(c) for c in columns]).first()
    wide = [c for c in columns if counts[c] > limit]
    if wide:
        raise ValueError(f"more than {limit} categories in {', '.join(wide)}")


def indexer(columns: Sequence[str] = CATEGORICAL_FEATURES, handle_invalid: str = "error") -> StringIndexer:
    """Most frequent value first, ties by name. ``keep`` gives unseen values an index of their own."""
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_index" for c in columns],
        stringOrderType="frequencyDesc",
        handleInvalid=handle_invalid,
    )


def wide_index(df: DataFrame, columns: Sequence[str], weight: str | None = None) -> DataFrame:
    """(column, value, index): the indexes that ``indexer`` gives, for columns with any number of values.

    Most frequent value first, ties by name; ``weight`` counts a row that often. The indexes are a table: no value
    comes to the driver, and ranks are running totals over ranges of the order.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    times = F.col(weight) if weight else F.lit(1)
    counted = (
        df.select(F.explode(cells).alias("cell"), times.alias("times"))
        .filter("cell.value IS NOT NULL")
        .groupBy("cell.column", "cell.value")
        .agg(F.sum("times").alias("n"))
        .withColumn("one", F.lit(1))
    )
    ranked = running_totals(counted, [F.desc("n"), F.asc("value")], "one", ["column"], "index")
    return ranked.select("column", "value", "index")


def with_index(df: DataFrame, indexes: DataFrame, column: str, output: str | None = None) -> DataFrame:
    """``df`` with the index of ``column`` as a double, null for null and for values that have none."""
    name = output or f"{column}_index"
    own = indexes.filter(F.col("column") == column).select(
        F.col("value").alias("_value"), F.col("index").cast("double").alias(name)
    )
    return attach_list(df.withColumn("_value", F.col(column).cast("string")), own, ["_value"], "left").drop("_value")


def encoder(columns: Sequence[str] = CATEGORICAL_FEATURES, handle_invalid: str = "error") -> OneHotEncoder:
    """One column per index but the last."""
    return OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns],
        outputCols=[f"{c}_encoded" for c in columns],
        dropLast=True,
        handleInvalid=handle_invalid,
    )


def assembler(
    numeric: Sequence[str] = NUMERIC_FEATURES, categorical: Sequence[str] = CATEGORICAL_FEATURES
) -> VectorAssembler:
    """Rows with a null or NaN feature are skipped; ``skipped_rows`` counts them."""
    return VectorAssembler(
        inputCols=[*numeric, *[f"{c}_encoded" for c in categorical]],
        outputCol=FEATURES,
        handleInvalid="skip",
    )


def scaler() -> MinMaxScaler:
    return MinMaxScaler(inputCol=FEATURES, outputCol=SCALED)


def feature_pipeline(
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
    handle_invalid: str = "error",
    extra: Sequence[object] = (),
) -> Pipeline:
    """Index, encode, assemble and scale; ``extra`` stages follow."""
    return Pipeline(
        stages=[
            indexer(categorical, handle_invalid),
            encoder(categorical, handle_invalid),
            assembler(numeric, categorical),
            scaler(),
            *extra,
        ]
    )


def category_counts(
    df: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES, label: str = LABEL
) -> DataFrame:
    """Rows per class and value of each column: (column, value, label, n), in one pass."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    seen = df.select(F.col(label).alias("label"), F.explode(F.array(*cells)).alias("cell"))
    return seen.groupBy("cell.column", "cell.value", "label").agg(F.count(F.lit(1)).alias("n"))


def fit_features(
    df: DataFrame,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
    label: str = LABEL,
    handle_invalid: str = "error",
) -> tuple[PipelineModel, int]:
    """What ``feature_pipeline`` fits on the balanced rows, and the number of copies that balance them.

    Two passes over the rows as they are: class and category counts, and the range of each feature. Copies
    change the order of categories by their number alone and a range not at all, so no row is repeated here.
    Without a categorical column the classes are counted alone.
    """
    counted = category_counts(df, categorical or [label], label).collect()
    first = (categorical or [label])[0]
    by_class = {k: sum(r.n for r in counted if r.column == first and r.label == k) for k in (0, 1)}
    if not by_class[1]:
        raise ValueError("cannot balance: no row of the positive class")
    copies = max(by_class[0] // by_class[1], 1)
    weights: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
    for r in counted:
        if r.value is not None and r.label in (0, 1):
            weights[r.column][r.value] += r.n * (copies if r.label else 1)
    indexes = [
        StringIndexerModel.from_labels(
            sorted(weights[c], key=lambda v: (-weights[c][v], v)), c, f"{c}_index", handle_invalid
        )
        for c in categorical
    ]
    rows = df.filter(F.col(label).isin(0, 1))
    stages = [*indexes, encoder(categorical, handle_invalid), assembler(numeric, categorical), scaler()]
    return Pipeline(stages=stages).fit(rows), copies


def _absent(field: T.StructField) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def skipped_rows(df: DataFrame, columns: Sequence[str] = NUMERIC_FEATURES) -> DataFrame:
    """How many rows the assembler skips: (kept_rows, skipped_rows)."""
    absent = [_absent(df.schema[c]) for c in columns]
    any_absent = absent[0]
    for test in absent[1:]:
        any_absent = any_absent | test
    return df.agg(
        F.count_if(~any_absent).alias("kept_rows"), F.count_if(any_absent).alias("skipped_rows")
    )
