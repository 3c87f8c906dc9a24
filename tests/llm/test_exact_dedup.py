from __future__ import annotations

import hashlib
import string

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

import compare
from conftest import MEDIUM
from riskflow.llm.exact_dedup import drop_exact_duplicates, exact_duplicates, hash_keys
from riskflow.llm.queries import queries
from riskflow.llm.sql import oracle_sql

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute_force(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(FOLD), []).append(i)
    found = []
    for text, ids in groups.items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        found += [(i, max(ids), len(ids), i == max(ids), digest) for i in ids]
    return sorted(found)


def test_query_equals_sql(spark):
    connection = compare.oracle(MEDIUM)
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{MEDIUM}/documents.parquet'")
    result = queries()["op1_exact_dedup"](spark, MEDIUM).toArrow()
    assert compare.differences(result, connection.sql(oracle_sql()["op1_exact_dedup"]).to_arrow_table()) == []


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.text("aAbÉé ", max_size=9)), min_size=1, max_size=12))
def test_small_blocks_equal_brute_force(spark, texts):
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, exact_duplicates(docs, block_bytes=2).collect())) == brute_force(rows)


def test_blocks_that_differ_late_and_in_length(spark):
    base = "x" * 9000
    texts = [base, base + "y", base[:-1] + "y", base.upper(), base[:8192], base[:4096], "", None, "é" * 5000, "é" * 5000]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, exact_duplicates(docs).collect())) == brute_force(rows)


def test_clashing_keys_are_made_again(spark):
    def constant(block):
        return F.struct(F.lit(1).cast("long").alias("k1"), F.lit(2).cast("long").alias("k2"))

    rows = [(1, "a"), (2, "b"), (3, "A")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = exact_duplicates(docs, keys=iter([constant, next(hash_keys())]))
    assert sorted(map(tuple, found.collect())) == brute_force(rows)


def test_repeated_rows_null_ids_and_clashing_names(spark):
    data = [(1, "a"), (1, "A"), (1, "b"), (None, "b"), (None, "c"), (None, "c"), (5, "c" * 20000)]
    docs = spark.createDataFrame(
        [(i, t, 7, "z", 0) for i, t in data], "doc_id long, text string, row int, name string, kept int"
    )
    found = exact_duplicates(docs)
    assert found.count() == 7
    kept = sorted((r.doc_id or -1, r.keep_id or -1, r.group_size) for r in found.filter("kept").collect())
    assert kept == [(-1, -1, 2), (1, 1, 2), (1, 1, 2), (5, 5, 1)]
    stays = drop_exact_duplicates(docs)
    assert stays.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text[:1].lower()) for r in stays.collect()) == [(-1, "c"), (1, "a"), (1, "b"), (5, "c")]


@pytest.mark.parametrize("call", [exact_duplicates, drop_exact_duplicates])
def test_empty_table(spark, call):
    assert call(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_plan_has_no_python(spark):
    plan = queries()["op1_exact_dedup"](spark, MEDIUM)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_stage_with_clashing_names_and_repeated_rows(spark):
    from riskflow.llm.exact_dedup import drop_exact_duplicates
    from riskflow.llm.simhash import drop_near_duplicates

    names = "doc_id long, text string, _kept_id long, _kept_text string, row int, id int, print string, _leader int, leader_id int"
    data = [(1, "a b c", 1, "x", 2, 1, "p", 1, 1), (1, "a b c", 1, "x", 1, 1, "p", 1, 1), (2, "d e f g", 9, "y", 3, 3, "q", 2, 2)]
    docs = spark.createDataFrame(data, names)
    for stage in (drop_exact_duplicates, drop_near_duplicates):
        kept = stage(docs)
        assert kept.columns == docs.columns
        # Of rows that agree in id and text the one with the smaller JSON text, that is, with row = 1.
        assert sorted(map(tuple, kept.collect())) == [data[1], data[2]]
        assert stage(docs.filter("row <> 2")).count() == 2
        assert stage(docs.limit(0)).count() == 0
