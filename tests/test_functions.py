from __future__ import annotations

import hashlib
import math

import pytest
from pyspark.sql import functions as F, types as T

from riskflow import functions as fn
from riskflow.functions.hashing import SLICES_PER_DIGEST, digest, poisson_thresholds


def values(df, column="out"):
    return [row[column] for row in df.collect()]


@pytest.mark.parametrize(
    "text, blank",
    [
        (None, True),
        ("", True),
        ("   ", True),
        ("NaN", True),
        ("nan", True),
        (" NaN ", True),
        ("+NaN", True),
        ("banana", False),
        ("0", False),
        ("x", False),
        (" 12 ", False),
    ],
)
def test_blank_text(spark, text, blank):
    df = spark.createDataFrame([(text,)], "v string")
    out = df.select(fn.is_blank(F.col("v")).alias("b"), fn.blank_to_null(F.col("v")).alias("out")).first()
    assert out["b"] is blank
    assert out["out"] == (None if blank else text)


def test_nan_texts_agree_with_the_cast(spark):
    texts = ["NaN", "nan", "NAN", "-NaN", "+nan", "\tNaN", "nano", "n/a", "1e5", "Infinity"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    guarded = fn.values._reads_as_nan(F.col("v"))
    plain = F.isnan(F.col("v").try_cast("double"))
    assert df.filter(guarded != plain).count() == 0


def test_blank_depends_on_type(rows):
    df = rows([(1.0,), (float("nan"),), (None,)], "v double")
    assert values(df.select(fn.blank_to_null(F.col("v"), T.DoubleType()).alias("out"))) == [1.0, None, None]
    df = rows([(0,), (None,)], "v int")
    assert values(df.select(fn.blank_to_null(F.col("v"), T.IntegerType()).alias("out"))) == [0, None]


def test_zero_texts_agree_with_the_cast(spark):
    texts = ["0", "0.0", "-0", "+0", " 0 ", "\t0", ".0", "0e7", "0d", "0x0p0", "00", "1", "-", "x0", "", "2020-01-01"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "v string")
    plain = F.coalesce(F.col("v").try_cast("double") == 0, F.lit(False))
    assert df.filter(fn.zero_value(F.col("v")) != plain).count() == 0
    assert df.filter(fn.missing_or_zero(F.col("v"))).count() == df.filter(plain | F.col("v").isNull()).count()


def test_risk_bucket_edges(rows):
    cases = [
        (None, "Unknown"),
        (float("nan"), "NA"),
        (0.0, "Under 10"),
        (9.99, "Under 10"),
        (10.0, "Between 10 and 25"),
        (25.0, "Between 10 and 25"),
        (25.01, "Between 25,.. and 50"),
        (50.0, "Between 25,.. and 50"),
        (50.01, "Between 50,.. and 50"),
        (75.0, "Between 50,.. and 50"),
        (75.01, "Over 75"),
        (100.0, "Over 75"),
    ]
    df = rows([(v, label) for v, label in cases], "v double, label string")
    assert df.filter(fn.risk_bucket(F.col("v")) != F.col("label")).count() == 0


def test_bucket_needs_ascending_edges(spark):
    with pytest.raises(ValueError):
        fn.bucket(F.lit(1.0), [(2.0, True, "b"), (1.0, True, "a")], "c")


def test_bad_times_become_null(rows):
    df = rows([("2020-01-02 03:04:05",), ("2020-01-02 24:00:00",), ("x",), (None,)], "v string")
    out = values(df.select(F.hour(fn.parse_timestamp(F.col("v"))).alias("out")))
    assert out == [3, None, None, None]


def test_division_by_zero(rows):
    df = rows([(1, 0), (1, 4)], "a int, b int")
    assert values(df.select(fn.ratio(F.col("a"), F.col("b")).alias("out"))) == [None, 0.25]
    assert values(df.select(fn.ratio(F.col("a"), F.col("b"), 0.0).alias("out"))) == [0.0, 0.25]


def test_split_shares_and_order(spark):
    df = spark.range(20_000).withColumn("s", fn.split_index([F.col("id")], [0.5, 0.3, 0.2]))
    shares = {r["s"]: r["count"] / 20_000 for r in df.groupBy("s").count().collect()}
    assert shares == pytest.approx({0: 0.5, 1: 0.3, 2: 0.2}, abs=0.02)
    expected = int(hashlib.md5(b"7:").hexdigest()[:8], 16) / 16**8
    got = df.filter("id = 7").first()["s"]
    assert got == (expected >= 0.5) + (expected >= 0.8)


def test_poisson_weights_follow_the_distribution(spark):
    n, rate = 40_000, 0.1
    draws = spark.range(n // SLICES_PER_DIGEST).withColumn("d", digest([F.col("id")]))
    draws = draws.select("d", F.explode(F.sequence(F.lit(0), F.lit(SLICES_PER_DIGEST - 1))).alias("k"))
    weights = draws.select(fn.poisson_weight(fn.hash_slice(F.col("d"), F.col("k")), rate).alias("w"))
    counts = {r["w"]: r["count"] for r in weights.groupBy("w").count().collect()}
    for k in (0, 1, 2):
        expected = math.exp(-rate) * rate**k / math.factorial(k)
        spread = math.sqrt(expected * (1 - expected) / n)
        assert abs(counts[k] / n - expected) < 5 * spread


def test_poisson_thresholds_rise():
    for rate in (0.1, 1.0, 3.0):
        bounds = poisson_thresholds(rate)
        assert bounds == sorted(bounds) and len(set(bounds)) == len(bounds)
        assert int(bounds[0], 16) / 16**8 == pytest.approx(math.exp(-rate), abs=1e-9)


def _tail(t: float, dof: int, steps: int = 200_000) -> float:
    """Two-sided p by numeric integration of the density."""
    scale = math.exp(math.lgamma((dof + 1) / 2) - math.lgamma(dof / 2)) / math.sqrt(dof * math.pi)
    h = t / steps
    total = 0.0
    for i in range(steps + 1):
        weight = 1 if i in (0, steps) else 4 if i % 2 else 2
        total += weight * (1 + (i * h) ** 2 / dof) ** (-(dof + 1) / 2)
    return 1 - 2 * scale * total * h / 3


@pytest.mark.parametrize("dof", [1, 2, 3, 4, 5, 9, 18])
def test_two_sided_p(spark, dof):
    ts = [0.5, 2.1, -2.88]
    df = spark.createDataFrame([(t, dof) for t in ts], "t double, dof int")
    got = values(df.select(fn.two_sided_p(F.col("t"), F.col("dof")).alias("out")))
    assert got == pytest.approx([_tail(abs(t), dof) for t in ts], abs=1e-9)


def test_p_of_null_is_null(spark):
    df = spark.createDataFrame([(None, 18)], "t double, dof int")
    assert values(df.select(fn.two_sided_p(F.col("t"), F.col("dof")).alias("out"))) == [None]


@pytest.mark.parametrize("dof, point", [(1, 12.7062047362), (2, 4.3026527297), (9, 2.2621571628), (18, 2.1009220402)])
def test_t_critical(dof, point):
    assert fn.t_critical(0.95, dof) == pytest.approx(point, abs=1e-9)
