"""The jobs a user runs: clean, add features, train, compare, score, decode a stream.

Each job reads files, writes files and holds nothing in between that grows with the data. Where a result
is used more than once it is written first, so that a lost executor costs a re-read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from riskflow.fixed_values import (
    CATEGORICAL_FEATURES,
    LABEL,
    NUMERIC_FEATURES,
    REFIT_SEED,
    REFIT_WEIGHTS,
    RISK_BUCKET_NULL,
    SPLIT_WEIGHTS,
    TERMINAL_BUCKET,
)
from riskflow.operators import classify, compare
from riskflow.operators.encode import SCALED, check_categories, feature_pipeline, fit_features
from riskflow.operators.evaluate import area_under_roc, long_metrics
from riskflow.operators.features import enrich, terminal_profile, typed
from riskflow.operators.joins import small_enough
from riskflow.operators.quality import KEPT, Rules, audit_lines, profile, reject_reasons
from riskflow.operators.sampling import COPY, hash_split, oversample, with_split
from riskflow.session import materialize, pin_time_zone, run_scope, small_result
from riskflow.sinks import log_run, model_report, report_lines, run_rows, write_report_text, write_table
from riskflow.sources import kafka_options, parse_header, read_dated_lines, read_kafka_stream
from riskflow.streaming import decode_messages, start_table

ID = "tranaction_id"


def clean_job(
    spark: SparkSession,
    source: str | Sequence[str],
    target: str,
    rules: Rules | None = None,
    many_days: bool = False,
) -> dict[str, str]:
    """Text files to an audited table, a clean table within it, and a profile report.

    The text is read and shuffled once. The audited rows are written once, partitioned by verdict and
    date, so the clean table is one of its folders and the quarantine the others; the profile reads the
    columnar audit. Rows are compared within one date, as when days are processed one by one.

    After the shuffle every task holds rows of every date. That is right for a day or a few; with
    ``many_days`` rows are brought together by folder once more, in parts of even size, because otherwise
    each task would write a small file into each folder.
    """
    pin_time_zone(spark)
    lines, header = read_dated_lines(spark, source)
    rules = rules or Rules(columns=tuple(parse_header(header)))
    audited = audit_lines(lines, rules, by=("source_date",))
    if many_days:
        audited = audited.hint("rebalance", "verdict", "source_date")
    audit_path = write_table(audited, f"{target}/audit", "overwrite", ("verdict", "source_date"))
    stored = spark.read.schema(audited.schema).parquet(audit_path)
    return {
        "audit": audit_path,
        "clean": f"{audit_path}/verdict={KEPT}",
        "profile": write_report_text(profile(stored, rules), f"{target}/profile"),
        "reasons": write_report_text(reject_reasons(stored), f"{target}/reasons", "reason", "n"),
    }


def feature_job(spark: SparkSession, clean_path: str, target: str) -> str:
    """Clean text columns to typed transactions with their terminal's risk, by source date if known.

    Where the terminals are few enough to be broadcast, rows are not moved and a task writes the dates it read.
    More terminals are joined by shuffle, which leaves rows of every date in every task; they are brought together
    by date before they are written, a large date in several files.
    """
    pin_time_zone(spark)
    cleaned = spark.read.parquet(clean_path)
    dates = [c for c in ("source_date",) if c in cleaned.columns]
    transactions = typed(cleaned, keep=dates)
    with run_scope(spark):
        profiles = materialize(terminal_profile(transactions), "profiles")
        enriched = enrich(transactions, profiles)
        if dates and not small_enough(profiles):
            enriched = enriched.hint("rebalance", *dates)
        return write_table(enriched, target, "overwrite", dates)


@dataclass
class Prepared:
    """Encoded training and test rows, and the stages that encode."""

    train: DataFrame
    test: DataFrame
    encoding: PipelineModel


def _encoded(df: DataFrame, encoding: PipelineModel) -> DataFrame:
    return encoding.transform(df).select(ID, COPY, LABEL, SCALED)


def prepare(
    features: DataFrame,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
    weights: Sequence[float] = SPLIT_WEIGHTS,
    max_categories: int | None = None,
) -> Prepared:
    """Balance, fit the encoding on everything, then split.

    Copies of a fraud can fall on both sides and the encoding has seen the test rows; ``prepare_leak_free``
    avoids both. Rows are read three times, twice to fit and once to encode them, and repeated only in what
    is written.
    """
    check_categories(features, categorical, max_categories)
    encoding, copies = fit_features(features, numeric, categorical)
    once = encoding.transform(features).select(ID, LABEL, SCALED)
    balanced = oversample(once, copies=copies).select(ID, COPY, LABEL, SCALED)
    numbered = with_split(balanced, [ID, COPY], weights)
    stored = materialize(numbered, "encoded", ("split",))
    train, test = (stored.filter(F.col("split") == i).drop("split") for i in range(2))
    return Prepared(train, test, encoding)


def prepare_leak_free(
    transactions: DataFrame,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = (TERMINAL_BUCKET,),
    weights: Sequence[float] = SPLIT_WEIGHTS,
    max_categories: int | None = None,
) -> Prepared:
    """Split first; terminal risk, encoding and balance come from training rows only.

    The terminals' profile is stored once for both parts, and so are the training rows with it.
    """
    train_rows, test_rows = hash_split(transactions, [ID], weights)
    profiles = materialize(terminal_profile(train_rows), "profiles")
    train_features = materialize(enrich(train_rows, profiles), "train-features")
    unknown = F.coalesce(F.col(TERMINAL_BUCKET), F.lit(RISK_BUCKET_NULL))
    test_features = (
        enrich(test_rows, profiles).withColumn(TERMINAL_BUCKET, unknown).withColumn(COPY, F.lit(1))
    )
    check_categories(train_features, categorical, max_categories)
    encoding, copies = fit_features(train_features, numeric, categorical, handle_invalid="keep")
    balanced = oversample(train_features, copies=copies)
    return Prepared(
        materialize(_encoded(balanced, encoding), "encoded-train"),
        materialize(_encoded(test_features, encoding), "encoded-test"),
        encoding,
    )


def train_job(
    spark: SparkSession, features: DataFrame, runs_path: str, model_path: str, run_id: str
) -> DataFrame:
    """Fit the fixed-parameter model, log parameters and metrics, save encoding and model together.

    ``testAreaUnderROC`` is exact on the test rows; ``areaUnderROC`` is what fitting reports of the training rows.
    """
    with run_scope(spark):
        ready = prepare(features)
        model = classify.logistic().fit(ready.train)
        predictions = classify.predict(model, ready.test, [ID, COPY])
        measured = small_result(classify.evaluate(predictions))
        logged = run_rows(classify.parameters(spark, model), run_id, "LR", "param", "name")
        ranked = area_under_roc(predictions).select(F.lit("testAreaUnderROC").alias("metric"), F.col("auc").alias("value"))
        for values in (classify.training_summary(spark, model), long_metrics(measured), ranked):
            logged = logged.unionByName(run_rows(values, run_id, "LR", "metric"))
        log_run(logged, runs_path)
        classify.save_model(PipelineModel(stages=[*ready.encoding.stages, model]), model_path)
    return measured


def both_predictions(ready: Prepared, tuned_model: object, fixed_model: object) -> DataFrame:
    """Predictions of two models on the same test rows, marked LR and LR_TV."""
    fixed = classify.predict(fixed_model, ready.test, [ID, COPY]).withColumn("model", F.lit("LR"))
    tuned = classify.predict(tuned_model, ready.test, [ID, COPY]).withColumn("model", F.lit("LR_TV"))
    return fixed.unionByName(tuned)


def _compared(spark: SparkSession, ready: Prepared, parallelism: int) -> tuple[DataFrame, object]:
    """The report of the fixed and the tuned model, and the tuned model."""
    estimator = classify.logistic()
    fixed = estimator.fit(ready.train)
    tuned = classify.tune(ready.train, estimator, classify.parameter_grid(estimator), parallelism=parallelism)
    predictions = materialize(both_predictions(ready, tuned.bestModel, fixed), "predictions")
    replicates = compare.replicate_metrics(compare.replicate_counts(predictions, [ID, COPY]))
    measured = compare.moments(compare.long_scores(materialize(replicates, "replicates")))
    report = model_report(
        compare.summary(predictions),
        compare.two_sample_test(measured, "LR", "LR_TV"),
        compare.mean_interval(measured),
        classify.parameters(spark, tuned.bestModel),
    )
    return small_result(report), tuned.bestModel


def compare_job(spark: SparkSession, features: DataFrame, parallelism: int = 2) -> DataFrame:
    """Fit both models and report metrics, t-test, intervals and the chosen parameters."""
    with run_scope(spark):
        return _compared(spark, prepare(features), parallelism)[0]


def tune_job(
    spark: SparkSession, features: DataFrame, model_path: str, report_path: str, parallelism: int = 2
) -> DataFrame:
    """Tune, write the report as text, fit the best parameters on the larger part and save that model."""
    with run_scope(spark):
        report, best = _compared(spark, prepare(features), parallelism)
        report_lines(report).coalesce(1).write.mode("overwrite").text(report_path)
        refit(features, best, model_path)
    return report


def refit(
    features: DataFrame, best: classify.LogisticRegressionModel, path: str, handle_invalid: str = "error"
) -> PipelineModel:
    """Fit encoding and the best parameters on the larger part, and save them as one model.

    With ``handle_invalid="keep"`` the model scores categories that it has not seen.
    """
    balanced = oversample(features)
    train, _ = hash_split(balanced, [ID, COPY], REFIT_WEIGHTS, salt=str(REFIT_SEED))
    estimator = classify.logistic(
        best.getMaxIter(), best.getRegParam(), best.getElasticNetParam()
    ).setFitIntercept(best.getFitIntercept())
    pipeline = feature_pipeline(handle_invalid=handle_invalid, extra=[estimator])
    model = pipeline.fit(materialize(train, "refit"))
    classify.save_model(model, path)
    return model


def score_job(
    spark: SparkSession,
    features: DataFrame,
    model_path: str,
    runs_path: str | None = None,
    run_id: str = "",
    target: str | None = None,
) -> DataFrame:
    """Score a whole table with a saved model; metrics as (metric, value), logged if a path is given.

    ``rows`` are those of the table, ``skipped`` those with a missing feature, which the model leaves out.
    Predictions are written to ``target`` if it is given.
    """
    with run_scope(spark):
        predictions = classify.predict(classify.load_model(model_path), features, [ID])
        stored = materialize(predictions, "predictions") if target is None else predictions
        if target:
            write_table(predictions, target, "overwrite")
            stored = spark.read.schema(predictions.schema).parquet(target)
        rows, scored = features.count(), stored.count()
        counts = [("rows", float(rows)), ("scored", float(scored)), ("skipped", float(rows - scored))]
        counted = spark.createDataFrame(counts, "metric string, value double")
        measured = small_result(long_metrics(classify.evaluate(stored)).unionByName(counted))
        if runs_path:
            log_run(run_rows(measured, run_id, "saved", "metric"), runs_path)
    return measured


def stream_job(
    spark: SparkSession, servers: str, topic: str, target: str, checkpoint: str, **source: Mapping
) -> StreamingQuery:
    """Kafka topic to decoded rows in Parquet."""
    messages = read_kafka_stream(spark, kafka_options(servers, topic, **source))
    return start_table(
        decode_messages(messages), target, checkpoint, trigger={"processingTime": "5 seconds"}
    )
