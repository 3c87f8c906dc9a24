from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskflow import session
from riskflow.operators.quality import Rules
from riskflow.plans import jobs
from riskflow.sinks import (
    log_run,
    model_report,
    read_runs,
    report_lines,
    run_rows,
    write_clean,
    write_report_text,
    write_table,
)


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(3), path)
    with pytest.raises(Exception, match="(?i)already exists"):
        write_table(spark.range(3), path)
    write_clean(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5


def test_report_text(rows, spark, tmp_path):
    path = write_report_text(rows([("a", 1), ("b", 2)], "metric string, value bigint"), str(tmp_path / "r"))
    assert sorted(r[0] for r in spark.read.text(path).collect()) == ["a 1", "b 2"]


def test_runs_append(rows, spark, tmp_path):
    path = str(tmp_path / "runs")
    values = rows([("f1", 0.5)], "metric string, value double")
    log_run(run_rows(values, "r1", "LR", "metric"), path)
    log_run(run_rows(values, "r2", "LR", "metric"), path)
    runs = read_runs(spark, path)
    assert runs.columns == ["run_id", "model", "kind", "name", "value", "ts"]
    assert {r["run_id"] for r in runs.collect()} == {"r1", "r2"}


def test_model_report_sections(rows):
    summary = rows(
        [("LR", 1, 2, 3, 4, 0.1, 0.2, 0.3, 0.4)],
        "model string, tp bigint, tn bigint, fp bigint, fn bigint, "
        "accuracy double, precision double, recall double, f1 double",
    )
    test = rows([("f1", -2.5, 18, 0.02, False)], "metric string, t double, dof int, p_value double, reject boolean")
    interval = rows([("LR", "f1", 0.98331, 0.98336, 0.98341)], "model string, metric string, low double, mean double, high double")
    parameters = rows([("regParam", "0.5")], "name string, value string")
    lines = [r[0] for r in report_lines(model_report(summary, test, interval, parameters)).collect()]
    assert "metrics LR tp 1" in lines and "t-test f1 reject false" in lines
    assert "interval LR low 0.9833" in lines and "parameters regParam 0.5" in lines
    assert len(lines) == 8 + 3 + 3 + 1


def test_scratch_folder_comes_from_the_session(spark):
    assert session.scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_materialized_frames_are_read_from_files(spark):
    df = session.materialize(spark.range(10).withColumn("p", F.col("id") % 2), "t", ("p",))
    assert df.filter("p = 1").count() == 5
    plan = df.filter("p = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan


def test_clean_and_feature_jobs(spark, raw_file, tmp_path):
    paths = jobs.clean_job(spark, raw_file, str(tmp_path / "clean"))
    profile = dict(r[0].rsplit(" ", 1) for r in spark.read.text(paths["profile"]).collect())
    assert profile["count_all_rows"] == "11" and profile["count_duplicates_rows"] == "1"
    assert profile["count_del_rows"] == "8"
    clean = spark.read.parquet(paths["clean"])
    assert sorted(r["tranaction_id"] for r in clean.collect()) == ["1", "10", "2"]
    reasons = dict(r[0].rsplit(" ", 1) for r in spark.read.text(paths["reasons"]).collect())
    assert reasons["ragged"] == "1" and reasons["kept"] == "3"
    enriched = spark.read.parquet(jobs.feature_job(spark, paths["clean"], str(tmp_path / "features")))
    rates = {r["tranaction_id"]: r["percent_fraud_on_terminal"] for r in enriched.collect()}
    assert rates == {"1": 50.0, "2": 50.0, "10": 100.0}
    assert {str(r["source_date"]) for r in enriched.collect()} == {"2020-01-02"}


def test_features_of_many_terminals_are_written_by_date(spark, tmp_path, monkeypatch):
    days = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 20).cast("int"))
    rows = spark.range(0, 4000, 1, 8).select(
        F.col("id").cast("string").alias("tranaction_id"),
        F.lit("2020-01-01 03:04:05").alias("tx_datetime"),
        F.lit("17").alias("customer_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 900).cast("string").alias("terminal_id"),
        F.lit("2.5").alias("tx_amount"),
        (F.col("id") % 7 == 0).cast("int").cast("string").alias("tx_fraud"),
        F.lit("0").alias("tx_fraud_scenario"),
        days.alias("source_date"),
    )
    source = write_table(rows, str(tmp_path / "clean"))
    few = spark.read.parquet(jobs.feature_job(spark, source, str(tmp_path / "few")))
    for module in ("riskflow.operators.joins", "riskflow.plans.jobs"):
        monkeypatch.setattr(f"{module}.small_enough", lambda *_: False)
    many = spark.read.parquet(jobs.feature_job(spark, source, str(tmp_path / "many")))
    assert many.count() == 4000 and many.exceptAll(few).isEmpty()
    assert len(many.inputFiles()) == 20 < len(few.inputFiles())


def test_clean_job_with_strict_rules(spark, raw_file, tmp_path):
    paths = jobs.clean_job(spark, raw_file, str(tmp_path / "clean"), Rules(require_timestamp=True))
    assert spark.read.parquet(paths["clean"]).count() == 2


def test_clean_job_over_many_days(spark, tmp_path):
    header = "#tranaction_id|tx_datetime|customer_id|terminal_id|tx_amount|tx_fraud|tx_fraud_scenario\n"
    (tmp_path / "raw").mkdir()
    for day in range(1, 6):
        rows = "".join(f"{i},2020-01-0{day} 03:04:05,17,{i % 9 + 1},2.5,0,0\n" for i in range(50))
        (tmp_path / "raw" / f"2020-01-0{day}.txt").write_text(header + rows + rows)
    counts = []
    for many_days in (False, True):
        paths = jobs.clean_job(spark, str(tmp_path / "raw"), str(tmp_path / str(many_days)), many_days=many_days)
        clean = spark.read.parquet(paths["clean"])
        counts.append({str(r["source_date"]): r["count"] for r in clean.groupBy("source_date").count().collect()})
    assert counts[0] == counts[1] == {f"2020-01-0{day}": 50 for day in range(1, 6)}
    assert len(clean.inputFiles()) == 5
