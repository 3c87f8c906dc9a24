"""Values of fitted models against their definitions in numpy: what SQL cannot check."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from riskflow.fixed_values import LABEL, TUNING_TRAIN_RATIO
from riskflow.operators import classify, compare
from riskflow.operators.encode import SCALED
from riskflow.operators.evaluate import area_under_roc
from riskflow.operators.sampling import COPY
from riskflow.plans import catalog, jobs
from riskflow.session import materialize

from conftest import SMALL


@pytest.fixture(scope="module")
def prepared_features(spark):
    return materialize(catalog._features(spark, SMALL), "features")


@pytest.fixture(scope="module")
def ready(prepared_features):
    return jobs.prepare(prepared_features)


def vectors(df):
    rows = df.select(vector_to_array(SCALED).alias("x"), LABEL).collect()
    return np.array([r["x"] for r in rows]), np.array([r[LABEL] for r in rows], dtype=float)


def pair_auc(score, label):
    """By its definition: over all pairs of a positive and a negative row."""
    positive, negative = score[label == 1][:, None], score[label == 0][None, :]
    return float(np.mean((positive > negative) + 0.5 * (positive == negative)))


def two_sided(t, dof):
    """The density of Student's t, integrated by Simpson's rule."""
    log_scale = math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2) - 0.5 * math.log(dof * math.pi)
    x = np.linspace(0, abs(t), 200_001)
    y = np.exp(log_scale - (dof + 1) / 2 * np.log1p(x * x / dof))
    return 1 - 2 * (x[1] - x[0]) / 3 * (y[0] + y[-1] + 4 * y[1:-1:2].sum() + 2 * y[2:-1:2].sum())


@pytest.mark.parametrize("reg,alpha", [(0.01, 0.5), (0.05, 0.8), (0.2, 0.0)])
def test_coefficients_are_the_optimum(ready, reg, alpha):
    """No subgradient of the mean loss with elastic net, on features of unit deviation, is left."""
    model = classify.logistic(500, reg, alpha).setTol(1e-13).fit(ready.train)
    x, y = vectors(ready.train)
    deviation = x.std(axis=0, ddof=1)
    w = model.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + model.intercept)))
    varied = deviation > 0
    slope = (x[:, varied] * (p - y)[:, None]).mean(axis=0) / deviation[varied]
    standard = w[varied] * deviation[varied]
    inside = standard == 0
    assert abs((p - y).mean()) < 1e-4
    assert np.all(np.abs(slope[inside]) <= reg * alpha + 1e-4)
    pull = slope + reg * (1 - alpha) * standard + reg * alpha * np.sign(standard)
    assert np.abs(pull[~inside]).max() < 1e-4
    assert not w[~varied].any()


def test_predictions_and_areas_follow_from_the_coefficients(ready):
    model = classify.logistic().fit(ready.train)
    predicted = classify.predict(model, ready.test, [jobs.ID, COPY])
    x, y = vectors(ready.test)
    p = 1 / (1 + np.exp(-(x @ model.coefficients.toArray() + model.intercept)))
    rows = predicted.collect()
    assert np.sort([r["probability"] for r in rows]) == pytest.approx(np.sort(p), abs=1e-12)
    assert all(r["prediction"] == (r["probability"] > 0.5) for r in rows)
    assert area_under_roc(predicted).head().auc == pytest.approx(pair_auc(p, y), abs=1e-9)
    x, y = vectors(ready.train)
    trained = x @ model.coefficients.toArray()
    assert model.summary.areaUnderROC == pytest.approx(pair_auc(trained, y), abs=1e-9)
    assert model.summary.accuracy == pytest.approx(np.mean((trained + model.intercept > 0) == y), abs=1e-12)


def test_areas_of_the_search(spark, ready):
    estimator = classify.logistic(5)
    grid = classify.parameter_grid(estimator, (0.01, 0.5), (True,), (0.0, 0.5))
    fitted = classify.tune(ready.train, estimator, grid)
    held_out = ready.train.randomSplit([TUNING_TRAIN_RATIO, 1 - TUNING_TRAIN_RATIO], 42)[1]
    x, y = vectors(held_out)
    for found, model in zip(classify.search_results(spark, fitted, grid).collect(), fitted.subModels):
        assert found["auc"] == pytest.approx(pair_auc(x @ model.coefficients.toArray(), y), abs=1e-9)


def test_comparison_of_fitted_models(spark):
    """Without leaks, as the features of ``prepare`` tell the classes apart without fault."""
    ready = jobs.prepare_leak_free(catalog._stored(spark, SMALL))
    fixed = classify.logistic().fit(ready.train)
    other = classify.logistic(8, 0.01, 0.0).fit(ready.train)
    predictions = materialize(jobs.both_predictions(ready, other, fixed), "both")
    counts = compare.replicate_counts(predictions, [jobs.ID, COPY]).collect()
    f1 = {m: np.array([2 * r.tp / max(2 * r.tp + r.fp + r.fn, 1) for r in counts if r.model == m]) for m in ("LR", "LR_TV")}
    a, b = f1["LR"], f1["LR_TV"]
    assert len(a) == len(b) == 10 and a.std() + b.std() > 0
    replicates = compare.replicate_metrics(compare.replicate_counts(predictions, [jobs.ID, COPY]))
    measured = compare.moments(compare.long_scores(replicates))
    tested = compare.two_sample_test(measured, "LR", "LR_TV").filter("metric = 'f1'").first()
    t = (a.mean() - b.mean()) / math.sqrt((a.var(ddof=1) + b.var(ddof=1)) / 2 * (2 / 10))
    assert tested["t"] == pytest.approx(t, rel=1e-9) and tested["dof"] == 18
    assert tested["p_value"] == pytest.approx(two_sided(t, 18), abs=1e-9)
    for row in compare.mean_interval(measured).collect():
        values = f1[row["model"]]
        half = row["high"] - row["mean"]
        assert row["mean"] == pytest.approx(values.mean(), abs=1e-12)
        if values.std() > 0:
            t_half = half / (values.std(ddof=1) / math.sqrt(10))
            assert 1 - two_sided(t_half, 9) == pytest.approx(0.95, abs=1e-9)


def test_a_mean_of_more_values_than_stated_is_refused(spark):
    data = [("A", i, "f1", i / 20) for i in range(12)]
    measured = compare.moments(spark.createDataFrame(data, "model string, replicate int, metric string, value double"))
    with pytest.raises(Exception, match="more than 10 values: 12"):
        compare.mean_interval(measured).collect()
    assert compare.mean_interval(measured, 12).first()["low"] is not None


def test_logged_values_and_named_coefficients(spark):
    found = {(r["kind"], r["name"]): r["value"] for r in catalog.model_values(spark, SMALL).collect()}
    metrics = {name: value for (kind, name), value in found.items() if kind == "metric"}
    learned = {name: value for (kind, name), value in found.items() if kind == "coefficient"}
    tp, tn, fp, fn = (metrics[n] for n in ("tp", "tn", "fp", "fn"))
    assert metrics["accuracy"] == pytest.approx((tp + tn) / (tp + tn + fp + fn))
    assert metrics["recall"] == pytest.approx(tp / (tp + fn)) and 0.5 < metrics["testAreaUnderROC"] <= 1
    assert "intercept" in learned and "tx_amount" in learned
    assert any("_encoded_" in name for name in learned)
