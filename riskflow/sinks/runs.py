"""Run tracking and model reports as tables."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskflow.session import materialize
from riskflow.sinks.versions import drop_old_versions, hadoop_path, publish, read_version


def run_rows(values: DataFrame, run_id: str, model: str, kind: str, name: str = "metric") -> DataFrame:
    """Named values of one run: (run_id, model, kind, name, value, ts); ``kind`` is param or metric."""
    return values.select(
        F.lit(run_id).alias("run_id"),
        F.lit(model).alias("model"),
        F.lit(kind).alias("kind"),
        F.col(name).alias("name"),
        F.col("value").cast("string").alias("value"),
        F.current_timestamp().alias("ts"),
    )


RUNS = "run_id string, model string, kind string, name string, value string, ts timestamp"


def log_run(rows: DataFrame, path: str) -> None:
    """Append, so that runs of several jobs share one table."""
    rows.coalesce(1).write.mode("append").parquet(path)


def _fresh(spark: SparkSession, path: str) -> DataFrame:
    """Logged rows that no version holds yet, with the file they lie in."""
    logged = spark.read.schema(RUNS).parquet(path).withColumn("_file", F.col("_metadata.file_path"))
    held = read_version(spark, path, schema="_file string", part="files")
    return logged.join(held, "_file", "left_anti")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All rows that were logged: those of the current version and those of files that came after it."""
    compacted = read_version(spark, path, schema=RUNS)
    return compacted.unionByName(_fresh(spark, path).drop("_file"))


def compact_runs(spark: SparkSession, path: str, files: int = 1) -> int:
    """Put all logged rows into a new version of few files that becomes current in one step, and return it.

    The version lists the log files that it holds. A file that is logged meanwhile is not among them, so it is
    read beside the version and goes into the next one. Readers of the old state go on until ``drop_logged``.
    """
    fresh = materialize(_fresh(spark, path), "fresh-runs")
    rows = read_version(spark, path, schema=RUNS).unionByName(fresh.drop("_file"))
    held = read_version(spark, path, schema="_file string", part="files")
    names = held.unionByName(fresh.select("_file").distinct())
    return publish(rows, path, {"files": names}, files)


def drop_logged(spark: SparkSession, path: str) -> int:
    """Delete log files that the current version holds, and older versions; for when their readers are done."""
    held = read_version(spark, path, schema="_file string", part="files")
    gone = 0
    for row in held.toLocalIterator():
        system, file = hadoop_path(spark, unquote(row._file))
        gone += system.delete(file, False)
    drop_old_versions(spark, path)
    return gone


def model_report(
    summary: DataFrame, test: DataFrame, intervals: DataFrame, parameters: DataFrame
) -> DataFrame:
    """Metrics by model, test outcome, intervals and chosen parameters as (section, name, value)."""
    names = ["accuracy", "precision", "recall", "f1", "tp", "tn", "fp", "fn"]
    as_text = summary.select("model", *[F.col(n).cast("string").alias(n) for n in names])
    model_rows = as_text.unpivot(["model"], names, "name", "value").select(
        F.concat(F.lit("metrics "), "model").alias("section"), "name", "value"
    )
    test_text = test.select("metric", *[F.col(n).cast("string").alias(n) for n in ("t", "p_value", "reject")])
    test_rows = test_text.unpivot(["metric"], ["t", "p_value", "reject"], "name", "value").select(
        F.concat(F.lit("t-test "), "metric").alias("section"), "name", "value"
    )
    bounds = intervals.select(
        "model", *[F.format_number(F.col(n), 4).alias(n) for n in ("low", "mean", "high")]
    )
    interval_rows = bounds.unpivot(["model"], ["low", "mean", "high"], "name", "value").select(
        F.concat(F.lit("interval "), "model").alias("section"), "name", "value"
    )
    parameter_rows = parameters.select(F.lit("parameters").alias("section"), "name", "value")
    return (
        model_rows.unionByName(test_rows).unionByName(interval_rows).unionByName(parameter_rows)
    )


def report_lines(report: DataFrame) -> DataFrame:
    """A report as text lines in a fixed order."""
    ordered = report.orderBy("section", "name")
    return ordered.select(F.concat_ws(" ", "section", "name", "value").alias("value"))
