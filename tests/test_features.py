from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskflow.fixed_values import TERMINAL_TOTAL
from riskflow.operators import features, joins

TX = "tranaction_id string, terminal_id int, tx_fraud int"


def test_terminal_profile(rows):
    data = [("a", 1, 1), ("b", 1, 0), ("c", 1, 0), ("d", 2, 0)]
    got = {tuple(r) for r in features.terminal_profile(rows(data, TX)).collect()}
    assert got == {(1, 3, 1, 33.33, "Between 25,.. and 50"), (2, 1, None, None, "Unknown")}
    zero = features.terminal_profile(rows(data, TX), zero_as_null=False).filter("terminal_id = 2").first()
    assert tuple(zero) == (2, 1, 0, 0.0, "Under 10")


def test_fraud_free_equals_an_anti_join(rows):
    df = rows([(str(i), i % 7, int(i % 7 < 3 and i % 2)) for i in range(100)], TX)
    profiles = features.terminal_profile(df)
    fraudulent = df.filter("tx_fraud = 1").select("terminal_id")
    expected = df.join(fraudulent, "terminal_id", "left_anti").groupBy("terminal_id").count()
    assert set(features.fraud_free_terminals(profiles).collect()) == set(expected.collect())
    assert [r[0] for r in features.first_by(profiles, "terminal_id", 2).collect()] == [0, 1]


def test_typed_columns(rows):
    df = rows(
        [("1", "2020-01-02 03:04:05", "17", " 42 ", "0.5", "1", "2"), ("2", "x", "18", "1", "3", "0", "0")],
        "tranaction_id string, tx_datetime string, customer_id string, terminal_id string, "
        "tx_amount string, tx_fraud string, tx_fraud_scenario string",
    )
    first, second = features.formatted_time(features.typed(df)).orderBy("tranaction_id").collect()
    assert tuple(first) == ("1", "2020-01-02 03:04:05", 17, 42, 0.5, 1, "2", 3)
    assert second["tx_datetime"] is None and second["hour_tx_datetime"] is None


@pytest.fixture()
def skewed(spark):
    """A third of the rows, all copies of one row, on one terminal; some rows without a terminal."""
    base = spark.range(6000)
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, None)
    spread = key.otherwise((F.col("id") % 2500 + 1000).cast("int"))
    return base.select(
        F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("tranaction_id"),
        spread.alias("terminal_id"),
        (F.col("id") % 5 == 0).cast("int").alias("tx_fraud"),
    )


@pytest.mark.parametrize("rows", [joins.BROADCAST_ROWS, 5])
def test_enrichment_equals_plain_join(skewed, monkeypatch, rows):
    monkeypatch.setattr(joins.small_enough, "__defaults__", (rows, joins.BROADCAST_BYTES))
    profiles = features.terminal_profile(skewed)
    expected = skewed.join(profiles, "terminal_id", "left").select("tranaction_id", *profiles.columns)
    got = features.enrich(skewed)
    assert Counter(got.select("tranaction_id", *profiles.columns).collect()) == Counter(expected.collect())
    assert ("ResolvedHint" in got._jdf.queryExecution().analyzed().toString()) == (rows > 5)


def test_wide_lookups_are_not_broadcast(spark, monkeypatch):
    left = spark.range(100).withColumnRenamed("id", "k")
    wide = left.withColumn("text", F.repeat(F.sha2(F.col("k").cast("string"), 256), 100))
    monkeypatch.setattr(joins.small_enough, "__defaults__", (joins.BROADCAST_ROWS, 1000))
    got = joins.attach_list(left, wide, ["k"], "left")
    assert "ResolvedHint" not in got._jdf.queryExecution().analyzed().toString()
    assert got.filter("text IS NULL").count() == 0


def test_list_join_uses_broadcast_only_for_short_lists(spark, monkeypatch):
    left = spark.range(100).withColumnRenamed("id", "k")
    keys = spark.range(10).withColumnRenamed("id", "k")
    short = joins.attach_list(left, keys, ["k"], "left_semi")
    assert "ResolvedHint" in short._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(joins.small_enough, "__defaults__", (5, joins.BROADCAST_BYTES))
    long = joins.attach_list(left, keys, ["k"], "left_semi")
    assert "ResolvedHint" not in long._jdf.queryExecution().analyzed().toString()
    assert short.count() == long.count() == 10
