from __future__ import annotations

import pytest
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskflow.fixed_values import TERMINAL_BUCKET
from riskflow.operators import classify, evaluate
from riskflow.operators.encode import (
    assembler,
    check_categories,
    encoder,
    feature_pipeline,
    indexer,
    skipped_rows,
)
from riskflow.operators.sampling import COPY
from riskflow.plans import catalog, jobs

from conftest import SMALL


@pytest.fixture(scope="module")
def prepared_features(spark):
    return catalog._features(spark, SMALL).cache()


@pytest.fixture(scope="module")
def ready(prepared_features):
    return jobs.prepare(prepared_features)


def test_index_order(rows):
    df = rows([("b",), ("b",), ("c",), ("a",)], "v string")
    indexed = indexer(["v"]).fit(df).transform(df)
    assert {r["v"]: r["v_index"] for r in indexed.collect()} == {"b": 0.0, "a": 1.0, "c": 2.0}


def test_unseen_values(rows):
    fitted = indexer(["v"]).fit(rows([("a",)], "v string"))
    with pytest.raises(Exception):
        fitted.transform(rows([("z",)], "v string")).collect()
    kept = indexer(["v"], "keep").fit(rows([("a",)], "v string"))
    assert kept.transform(rows([("z",)], "v string")).first()["v_index"] == 1.0


def test_one_hot_drops_the_last(rows):
    df = rows([("a",), ("a",), ("b",)], "v string")
    indexed = indexer(["v"]).fit(df).transform(df)
    encoded = encoder(["v"]).fit(indexed).transform(indexed)
    cells = encoded.select("v", vector_to_array("v_encoded").alias("x")).distinct().collect()
    assert {r["v"]: r["x"] for r in cells} == {"a": [1.0], "b": [0.0]}


def test_incomplete_rows_are_skipped_and_counted(rows):
    df = rows(
        [(1, 2, 3.0), (None, 2, 3.0), (1, None, 3.0), (1, 2, float("nan"))],
        "terminal_id int, hour_tx_datetime int, tx_amount double",
    )
    assert assembler(categorical=()).transform(df).count() == 1
    assert tuple(skipped_rows(df).first()) == (1, 3)


def test_too_many_categories(rows):
    df = rows([(str(i),) for i in range(50)], "v string")
    check_categories(df, ["v"], 60)
    with pytest.raises(ValueError, match="categories"):
        check_categories(df, ["v"], 10)


def test_pipeline_scales_to_unit_range(prepared_features):
    scaled = feature_pipeline().fit(prepared_features).transform(prepared_features)
    cells = scaled.select(F.explode(vector_to_array("scaledFeatures")).alias("x"))
    low, high = cells.agg(F.min("x"), F.max("x")).first()
    assert (low, high) == (0.0, 1.0)


def test_golden_metrics(rows):
    counts = rows([(7509150, 8361668, 0, 264110)], "tp bigint, tn bigint, fp bigint, fn bigint")
    got = evaluate.metrics(counts).first()
    assert got["accuracy"] == pytest.approx(0.9836311633990558, abs=1e-15)
    assert got["precision"] == 1.0
    assert got["recall"] == pytest.approx(0.9660232643704186, abs=1e-15)
    assert got["f1"] == pytest.approx(0.9827180398903053, abs=1e-15)


def test_metrics_without_positives(rows):
    counts = rows([(0, 5, 0, 0)], "tp bigint, tn bigint, fp bigint, fn bigint")
    nulls = evaluate.metrics(counts).first()
    assert nulls["precision"] is None and nulls["recall"] is None and nulls["f1"] is None
    zeros = evaluate.metrics(counts, undefined=0.0).first()
    assert (zeros["precision"], zeros["recall"], zeros["f1"], zeros["accuracy"]) == (0.0, 0.0, 0.0, 1.0)
    empty = evaluate.metrics(evaluate.confusion(rows([], "tx_fraud int, prediction double"))).first()
    assert empty["tp"] == 0 and empty["accuracy"] is None


def test_metrics_agree_with_spark(rows):
    data = [(int(i % 4 == 0), float(i % 3 == 0)) for i in range(200)]
    df = rows(data, "tx_fraud int, prediction double")
    got = evaluate.metrics(evaluate.confusion(df)).first()
    labels = df.withColumn("label", F.col("tx_fraud").cast("double"))
    spark_metric = MulticlassClassificationEvaluator(metricLabel=1.0)
    for ours, theirs in (
        ("accuracy", "accuracy"),
        ("precision", "precisionByLabel"),
        ("recall", "recallByLabel"),
        ("f1", "fMeasureByLabel"),
    ):
        assert got[ours] == pytest.approx(spark_metric.setMetricName(theirs).evaluate(labels), abs=1e-12)


def test_matrix_cells(rows):
    counts = rows([(1, 2, 3, 4)], "tp bigint, tn bigint, fp bigint, fn bigint")
    assert {tuple(r) for r in evaluate.confusion_matrix(counts).collect()} == {
        (1, 1, 1),
        (0, 0, 2),
        (0, 1, 3),
        (1, 0, 4),
    }


def test_preparation_splits_every_copy_once(prepared_features, ready):
    balanced = catalog.sampling.oversample(prepared_features).filter("hour_tx_datetime is not null")
    both = ready.train.unionByName(ready.test)
    assert both.count() == both.select(jobs.ID, COPY).distinct().count() == balanced.count()


def test_training_is_repeatable(ready):
    first = classify.logistic(max_iter=5).fit(ready.train)
    second = classify.logistic(max_iter=5).fit(ready.train)
    assert first.coefficients.toArray() == pytest.approx(second.coefficients.toArray(), abs=1e-9)
    assert first.summary.accuracy == pytest.approx(1.0, abs=0.1)


def test_default_parameters(spark, ready):
    model = classify.logistic().fit(ready.train)
    named = {r["name"]: r["value"] for r in classify.parameters(spark, model).collect()}
    assert (named["maxIter"], named["regParam"], named["elasticNetParam"]) == ("1", "0.2", "0.8")
    assert named["family"] == "binomial" and named["featuresCol"] == "scaledFeatures"
    summary = {r["metric"]: r["value"] for r in classify.training_summary(spark, model).collect()}
    assert 0.0 <= summary["accuracy"] <= 1.0 and 0.5 <= summary["areaUnderROC"] <= 1.0


def test_search_covers_the_grid_and_picks_the_best(spark, ready, prepared_features, tmp_path):
    estimator = classify.logistic()
    grid = classify.parameter_grid(estimator)
    fitted = classify.tune(ready.train, estimator, grid, parallelism=4)
    assert len(grid) == len(fitted.subModels) == 18
    results = classify.search_results(spark, fitted, grid).collect()
    chosen = [r for r in results if r["chosen"]]
    assert len(chosen) == 1 and chosen[0]["auc"] == max(r["auc"] for r in results)
    assert fitted.bestModel.getRegParam() == chosen[0]["reg_param"]
    refitted = jobs.refit(prepared_features, fitted.bestModel, str(tmp_path / "best")).stages[-1]
    assert refitted.getRegParam() == chosen[0]["reg_param"]
    assert refitted.getElasticNetParam() == chosen[0]["elastic_net_param"]
    assert refitted.getFitIntercept() == chosen[0]["fit_intercept"]


def test_saved_model_gives_the_same_predictions(spark, prepared_features, tmp_path):
    path = str(tmp_path / "model")
    model = jobs.refit(prepared_features, classify.logistic(max_iter=5, reg_param=0.01), path)
    before = classify.predict(model, prepared_features, [jobs.ID])
    after = classify.predict(classify.load_model(path), prepared_features, [jobs.ID])
    assert set(before.collect()) == set(after.collect())
    assert classify.load_model(path).stages[-1].getRegParam() == 0.01
    runs = str(tmp_path / "runs")
    scored = {r["metric"]: r["value"] for r in jobs.score_job(spark, prepared_features, path, runs, "r").collect()}
    logged = {r["name"]: float(r["value"]) for r in spark.read.parquet(runs).collect()}
    assert scored == logged and scored["accuracy"] > 0.7


def test_leak_free_order(spark):
    typed = catalog._stored(spark, SMALL)
    ready = jobs.prepare_leak_free(typed)
    train_ids = {r[0] for r in ready.train.select(jobs.ID).distinct().collect()}
    test_ids = [r[0] for r in ready.test.select(jobs.ID).collect()]
    assert not train_ids & set(test_ids) and len(test_ids) == len(set(test_ids))
    balance = {r["tx_fraud"]: r["count"] for r in ready.test.groupBy("tx_fraud").count().collect()}
    assert balance[1] < balance[0]
    inputs = [s.getInputCol() for s in ready.encoding.stages if isinstance(s, StringIndexerModel)]
    assert inputs == [TERMINAL_BUCKET]


def test_train_job_logs_and_saves(spark, prepared_features, tmp_path):
    runs, model = str(tmp_path / "runs"), str(tmp_path / "model")
    measured = jobs.train_job(spark, prepared_features, runs, model, "run-1").first()
    logged = spark.read.parquet(runs)
    kinds = {(r["kind"], r["name"]): r["value"] for r in logged.collect()}
    assert kinds["param", "regParam"] == "0.2"
    assert float(kinds["metric", "f1"]) == measured["f1"]
    assert "areaUnderROC" in {name for _, name in kinds}
    scored = classify.predict(classify.load_model(model), prepared_features, [jobs.ID])
    assert scored.count() == prepared_features.filter("hour_tx_datetime is not null").count()


def test_compare_job_report(spark, prepared_features):
    report = {(r["section"], r["name"]): r["value"] for r in jobs.compare_job(spark, prepared_features, 4).collect()}
    assert {"metrics LR", "metrics LR_TV", "t-test f1", "interval LR", "interval LR_TV", "parameters"} == {
        section for section, _ in report
    }
    assert float(report["interval LR", "low"]) <= float(report["interval LR", "high"])
