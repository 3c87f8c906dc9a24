from __future__ import annotations

import math
import random
import re
import string
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from conftest import MEDIUM, SMALL
from riskflow.llm import lexical, sql
from riskflow.llm.queries import queries

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k=50):
    """docs: (id, text); items: (id, text). (item, rank, doc, score) of every item."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, c.total()) for i, c in counted if c]
    big_n, big_l = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        own = set(terms(text)) & set(df)
        w = {t: math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) for t in own}
        scored = []
        for i, c, n in counted:
            m = 50 + 50 * n * big_n // big_l
            score = sum(w[t] * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in own if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def found(spark, docs, items, k=50):
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame(items, "item_id long, text string")
    return [tuple(r) for r in lexical.rank_documents(left, right, k).collect()]


def same(ours, theirs):
    assert sorted(ours, key=repr) == sorted(theirs, key=repr)


def test_query_equals_sql_and_brute_force(spark):
    result = [tuple(r) for r in queries()["op11_lexical_search"](spark, MEDIUM).collect()]
    with duckdb.connect() as connection:
        for table in ("documents", "benchmark"):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{MEDIUM}/{table}.parquet'")
        expected = connection.sql(sql.oracle_sql()["op11_lexical_search"]).fetchall()
        docs = connection.sql("SELECT doc_id, text FROM documents").fetchall()
        items = connection.sql("SELECT item_id, text FROM benchmark").fetchall()
    assert len(result) > len(items)
    assert sorted(result) == sorted(expected) == sorted(brute(docs, items))


def word(rng, n):
    return "w" + str(min(int(rng.paretovariate(0.7)), n))


@pytest.mark.parametrize("seed,shard_docs,block", [(1, 7, 2), (2, 50, 4), (3, 1000, 16), (4, 1000, 128)])
def test_shards_and_blocks_change_nothing(spark, monkeypatch, seed, shard_docs, block):
    rng = random.Random(seed)
    docs = [(i, " ".join(word(rng, 300) for _ in range(int(rng.paretovariate(0.8)) % 400))) for i in range(400)]
    docs += [(1000 + i, docs[i % 3][1]) for i in range(80)]  # ties around the last rank
    items = [(i, " ".join(word(rng, 300) for _ in range(rng.randrange(12)))) for i in range(30)] + [(77, docs[5][1])]

    def built(self):
        return len(self.ids) >= shard_docs

    # Workers load the module anew, so the shards are built and searched here.
    monkeypatch.setattr(lexical.ShardBuilder, "full", built)
    monkeypatch.setattr(lexical, "BLOCK", block)
    batches, builder = [], lexical.ShardBuilder()
    for i, text in docs:
        if t := lexical.terms_of(text):
            builder.add(i, t)
            if builder.full():
                batches.append(builder.rows(len(batches), pa.int64()))
                builder = lexical.ShardBuilder()
    if builder.ids:
        batches.append(builder.rows(len(batches), pa.int64()))
    df, n_docs, n_terms = Counter(), 0, 0
    for b in batches:
        for row in b.to_pylist():
            if row["term"] is None:
                n_docs, n_terms = n_docs + row["n"], n_terms + row["total"]
            else:
                df[row["term"]] += row["n"]
    asked = [
        lexical.Query(i, {t: lexical.weight(n_docs, df[t]) for t in set(terms(x)) if t in df}) for i, x in items
    ]
    columns = ["shard", "term", "n", "head", "data", "ids"]
    for k in (1, 5, 50):
        best = lexical._searched(iter([b.select(columns) for b in batches]), asked, n_docs, n_terms, k)
        ours = [(i, rank, doc, score) for i, heap in best.items() for rank, (score, doc) in enumerate(heap, 1)]
        same(ours, brute(docs, items, k))


def test_candidates_are_rejected_before_their_blocks_are_decoded():
    rng = np.random.default_rng(5)
    builder = lexical.ShardBuilder()
    for i in range(8000):
        builder.add(i, [b"often"] * int(rng.integers(1, 4)) + [b"x%d" % rng.integers(5000)] * 9 + ([b"rare"] * 3 if i % 800 == 0 else []))
    stored = {r["term"]: r for r in builder.rows(0, pa.int64()).to_pylist()}
    lengths = np.frombuffer(stored[None]["head"], "<i8")
    norm = lexical.norms(lengths, 8000, stored[None]["total"])
    lists = {
        t: lexical.PostingList(stored[t]["n"], stored[t]["head"], stored[t]["data"], 8000, stored[None]["total"], norm)
        for t in ("often", "rare")
    }
    own = [(lexical.weight(8000, stored[t]["n"]) + 1, lists[t]) for t in lists]
    docs, scores = lexical.search_shard(own, 8000, 5, 0)
    assert len(docs) >= 5 and (docs % 800 == 0).all()
    assert len(lists["often"].decoded) <= 10 < len(lists["often"].first)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcde"), min_size=1, max_size=40), min_size=1, max_size=300), st.integers(1, 70))
def test_coding_is_lossless_and_block_maxima_are_exact(texts, times):
    builder = lexical.ShardBuilder()
    texts = [[t.encode() for t in text] * (times if i % 7 == 0 else 1) for i, text in enumerate(texts)]
    for i, text in enumerate(texts):
        builder.add(i, text)
    rows = {r["term"]: r for r in builder.rows(3, pa.int64()).to_pylist()}
    n_docs, n_terms = len(texts), sum(map(len, texts))
    assert (rows[None]["n"], rows[None]["total"], rows[None]["ids"]) == (n_docs, n_terms, list(range(n_docs)))
    norm = lexical.norms(np.frombuffer(rows[None]["head"], "<i8"), n_docs, n_terms)
    for term in set(sum(texts, [])):
        row = rows[term.decode()]
        postings = lexical.PostingList(row["n"], row["head"], row["data"], n_docs, n_terms, norm)
        docs, impacts = postings.all
        expected = [(i, t.count(term)) for i, t in enumerate(texts) if term in t]
        assert docs.tolist() == [i for i, _ in expected]
        assert impacts.tolist() == [10**9 * f // (1000 * f + 20 * int(norm[i])) for i, f in expected]
        assert postings.maxima.tolist() == [int(postings.block(i)[1].max()) for i in range(len(postings.first))]
        assert row["total"] == sum(f for _, f in expected)


def test_large_gaps_and_frequencies():
    builder = lexical.ShardBuilder()
    for i in range(2000):
        builder.add(i, [b"a"] * (70_000 if i == 1500 else 1) if i % 700 == 0 or i == 1500 else [b"b"])
    rows = {r["term"]: r for r in builder.rows(0, pa.int64()).to_pylist()}
    total = rows[None]["total"]
    norm = lexical.norms(np.frombuffer(rows[None]["head"], "<i8"), 2000, total)
    postings = lexical.PostingList(rows["a"]["n"], rows["a"]["head"], rows["a"]["data"], 2000, total, norm)
    assert postings.all[0].tolist() == [0, 700, 1400, 1500]


def test_nulls_ties_and_repeated_rows(spark):
    docs = [(None, "a b"), (3, "a b"), (3, "a b"), (1, "A, b!"), (2, None), (4, ""), (5, " . "), (None, "a c"), (6, "É é x1")]
    items = [(1, "a"), (1, "a"), (1, "a b"), (None, "c"), (2, None), (3, "..."), (4, "zzz"), (5, "É X1 é")]
    distinct = [(1, "a"), (1, "a b"), (None, "c"), (5, "É X1 é")]
    same(found(spark, docs, items), brute(docs, distinct))
    same(found(spark, docs, items, 2), brute(docs, distinct, 2))


def test_many_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "QUERY_TERMS", 3)
    docs = [(i, f"t{i % 7} t{i % 3} t{i % 5}") for i in range(60)]
    items = [(i, f"t{i} t{i + 1} t{i + 2}") for i in range(6)]
    same(found(spark, docs, items, 4), brute(docs, items, 4))


def test_long_text_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(1, "x y " * 40_000, 1, "t", 1, "h"), (2, "y", 1, "t", 1, "h")],
        "doc_id long, text string, shard long, term string, n int, head string",
    )
    items = spark.createDataFrame([(9, "x y", 1, 2)], "item_id long, text string, number int, score int")
    rows = [(1, "x y " * 40_000), (2, "y")]
    same([tuple(r) for r in lexical.rank_documents(docs, items).collect()], brute(rows, [(9, "x y")]))
    assert lexical.rank_documents(docs.limit(0), items).count() == 0
    assert lexical.rank_documents(docs, items.limit(0)).count() == 0


def test_ids_of_other_types(spark):
    docs = spark.createDataFrame([("p", "a"), ("q", "a"), (None, "a b")], "doc_id string, text string")
    items = spark.createDataFrame([("i", "a")], "item_id string, text string")
    assert [r.doc_id for r in lexical.rank_documents(docs, items).orderBy("rank").collect()] == ["p", "q", None]


def test_index_holds_every_row_with_a_term(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    index = lexical.build_index(docs)
    held = index.filter("term IS NULL").selectExpr("explode(ids) AS doc_id").count()
    assert held == sum(bool(terms(r.text)) for r in docs.collect())
