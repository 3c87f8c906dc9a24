from __future__ import annotations

import hashlib
import math
import statistics

import pytest
from pyspark.sql import functions as F

from riskflow.functions.hashing import poisson_thresholds
from riskflow.operators import compare


@pytest.fixture(scope="module")
def predictions(spark):
    base = spark.range(400).withColumn("tx_fraud", (F.col("id") % 3 == 0).cast("int"))
    guess = F.when(F.col("id") % 10 == 0, 1 - F.col("tx_fraud")).otherwise(F.col("tx_fraud"))
    better = F.when(F.col("id") % 40 == 0, 1 - F.col("tx_fraud")).otherwise(F.col("tx_fraud"))
    one = base.select(F.lit("A").alias("model"), "id", "tx_fraud", guess.cast("double").alias("prediction"))
    two = base.select(F.lit("B").alias("model"), "id", "tx_fraud", better.cast("double").alias("prediction"))
    return one.unionByName(two)


def test_replicates_equal_brute_force(predictions):
    bounds = poisson_thresholds(0.1)
    expected = {}
    for row in predictions.collect():
        for replicate in range(10):
            text = f"{row['model']}:{row['id']}:{replicate // 4}"
            start = replicate % 4 * 8
            draw = hashlib.md5(text.encode()).hexdigest()[start : start + 8]
            weight = sum(draw >= bound for bound in bounds)
            cell = expected.setdefault((row["model"], replicate), dict.fromkeys(("tp", "tn", "fp", "fn"), 0))
            hit = row["tx_fraud"] == row["prediction"]
            name = ("t" if hit else "f") + ("p" if row["prediction"] == 1 else "n")
            cell[name] += weight
    counts = compare.replicate_counts(predictions, ["id"]).collect()
    assert {(r["model"], r["replicate"]): {k: r[k] for k in ("tp", "tn", "fp", "fn")} for r in counts} == expected


def test_replicate_numbers_need_not_fill_digests(predictions):
    counts = compare.replicate_counts(predictions, ["id"], replicates=6, rate=1.0)
    assert {r["replicate"] for r in counts.collect()} == set(range(6))
    total = counts.agg(F.sum(F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"))).first()[0]
    assert total == pytest.approx(800 * 6, rel=0.05)


@pytest.fixture(scope="module")
def scores(spark):
    a = [0.90, 0.91, 0.89, 0.92, 0.90, 0.88, 0.91, 0.90, 0.93, 0.89]
    b = [0.92, 0.93, 0.91, 0.94, 0.92, 0.93, 0.95, 0.92, 0.94, 0.91]
    data = [(m, i, "f1", v) for m, vs in (("A", a), ("B", b)) for i, v in enumerate(vs)]
    return spark.createDataFrame(data, "model string, replicate int, metric string, value double"), a, b


def test_t_test(scores):
    df, a, b = scores
    got = compare.two_sample_test(compare.moments(df), "A", "B").first()
    pooled = (9 * statistics.variance(a) + 9 * statistics.variance(b)) / 18
    t = (statistics.mean(a) - statistics.mean(b)) / math.sqrt(pooled * 2 / 10)
    assert got["t"] == pytest.approx(t, rel=1e-9) and got["dof"] == 18
    assert got["reject"] is True and 0 < got["p_value"] < 0.01


def test_t_test_without_variation(spark):
    data = [(m, i, "f1", 1.0) for m in "AB" for i in range(10)]
    df = spark.createDataFrame(data, "model string, replicate int, metric string, value double")
    got = compare.two_sample_test(compare.moments(df), "A", "B").first()
    assert got["t"] is None and got["p_value"] is None and got["reject"] is None


def test_interval_and_bands(scores):
    df, a, _ = scores
    measured = compare.moments(df)
    row = compare.mean_interval(measured).filter("model = 'A'").first()
    half = 2.2621571628 * statistics.stdev(a) / math.sqrt(10)
    assert row["high"] - row["mean"] == pytest.approx(half, rel=1e-8)
    band = compare.sigma_bands(measured).filter("model = 'A'").first()
    assert band["high_3"] - band["low_3"] == pytest.approx(6 * statistics.stdev(a))


def test_density_encloses_its_mass(scores):
    df, _, _ = scores
    points = compare.density(compare.moments(df)).filter("model = 'A'").orderBy("point").collect()
    assert len(points) == 100
    area = sum((q["x"] - p["x"]) * (p["y"] + q["y"]) / 2 for p, q in zip(points, points[1:]))
    assert area == pytest.approx(0.9973, abs=1e-3)


def test_histogram_counts_every_value(scores):
    df, a, _ = scores
    bins = {r["bin"]: r["n"] for r in compare.histogram(df, bins=5).filter("model = 'A'").collect()}
    assert sum(bins.values()) == len(a) and set(bins) <= set(range(5)) and 4 in bins
    same = df.withColumn("value", F.lit(1.0))
    assert {r["bin"] for r in compare.histogram(same).collect()} == {0}


def test_bootstrap_shuffles_only_counts(predictions):
    plan = compare.replicate_counts(predictions, ["id"])._jdf.queryExecution().executedPlan().toString()
    # The counts, the models, and the models spread over replicates; rows stay where they are.
    assert "partial_sum" in plan and plan.count("Exchange hashpartitioning") <= 3
