"""Every catalog query against its SQL; queries without SQL against what must hold for them."""

from __future__ import annotations

import pytest

import compare
from __spark_entry__ import entry
from riskflow.plans.catalog import queries
from riskflow.plans.oracles import oracle_sql

from conftest import MEDIUM

QUERIES, ORACLES = queries(), oracle_sql()
WITHOUT_SQL = {"sample_with_replacement", "model_values", "comparison_values", "search_values"}


@pytest.fixture(scope="module")
def connection():
    return compare.oracle(MEDIUM)


def test_only_random_samples_and_fitted_values_lack_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, connection, name):
    result = QUERIES[name](spark, MEDIUM).toArrow()
    assert result.num_rows > 0
    assert compare.differences(result, connection.sql(ORACLES[name]).to_arrow_table()) == []


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert {"terminal_id", "percent_fraud_on_terminal", "percent_fraud_on_terminal_udf"} <= set(df.columns)
