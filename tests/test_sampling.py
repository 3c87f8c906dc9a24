from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskflow.operators import sampling


def labelled(rows, negatives, positives):
    data = [(i, 0) for i in range(negatives)] + [(1000 + i, 1) for i in range(positives)]
    return rows(data, "id int, tx_fraud int")


@pytest.mark.parametrize("negatives, positives, copies", [(10, 3, 3), (10, 10, 1), (3, 10, 1), (7, 1, 7)])
def test_oversample(rows, negatives, positives, copies):
    df = labelled(rows, negatives, positives)
    counts = {r["tx_fraud"]: r["count"] for r in sampling.oversample(df).groupBy("tx_fraud").count().collect()}
    assert counts == {0: negatives, 1: positives * copies}
    one_pass = Counter(sampling.oversample(df).collect())
    assert one_pass == Counter(sampling.oversample_by_union(df).collect())
    assert max(one_pass.values()) == 1


def test_oversample_drops_unlabelled_rows(rows):
    df = rows([(1, 0), (2, 1), (3, None), (4, 2)], "id int, tx_fraud int")
    assert sorted(r["id"] for r in sampling.oversample(df).collect()) == [1, 2]


def test_no_positive_rows_is_a_clear_error(rows):
    with pytest.raises(Exception, match="no row of the positive class"):
        sampling.oversample(labelled(rows, 5, 0)).collect()


def test_class_balance(rows):
    assert tuple(sampling.class_balance(labelled(rows, 10, 3)).first()) == (10, 3, 3)
    assert tuple(sampling.class_balance(labelled(rows, 10, 0)).first()) == (10, 0, None)


@pytest.mark.parametrize("split", ["hash", "random"])
def test_splits_are_disjoint_and_complete(spark, split):
    df = spark.range(5000)
    if split == "hash":
        parts = sampling.hash_split(df, ["id"], [0.7, 0.3])
    else:
        parts = sampling.random_split(df, [0.7, 0.3], 1)
    ids = [{r["id"] for r in part.collect()} for part in parts]
    assert ids[0] | ids[1] == set(range(5000)) and not ids[0] & ids[1]
    assert len(ids[0]) == pytest.approx(3500, rel=0.05)


def test_hash_split_does_not_depend_on_partitions(spark):
    ids = [
        {r["id"] for r in sampling.hash_split(spark.range(1000).repartition(n), ["id"])[1].collect()}
        for n in (1, 7)
    ]
    assert ids[0] == ids[1]


def test_split_needs_no_shuffle(spark):
    plan = sampling.with_split(spark.range(10), ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_sample_with_replacement(spark):
    df = spark.range(20_000)
    sample = sampling.sample_with_replacement(df, 0.5, 3)
    assert sample.count() == pytest.approx(10_000, rel=0.05)
    assert sample.groupBy("id").count().filter(F.col("count") > 1).count() > 0
