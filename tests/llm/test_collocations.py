from __future__ import annotations

import re
import string
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from conftest import MEDIUM
from riskflow.llm import sql
from riskflow.llm.collocations import Suffixes, _windows, collocations, frequent_phrases, quicksort_phrases, words_of
from riskflow.llm.queries import queries

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def pieces(text):
    for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(FOLD)):
        yield re.findall(r"[^ \t]+", piece)


def counted(rows):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for size in range(1, 5):
                f.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    return f, n


def brute(rows, least, top=2000):
    f, n = counted(rows)
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    longest = defaultdict(int)
    for (lang, words), a in found.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                key = lang, words[i : i + size]
                longest[key] = max(longest[key], a)
    by_lang = defaultdict(list)
    for (lang, words), a in found.items():
        if 100 * longest[lang, words] >= 80 * a:
            continue
        score, k = min((2000000 * a // (f[lang, words[:k]] + f[lang, words[k:]]), k) for k in range(1, len(words)))
        by_lang[lang].append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return {
        (lang, rank, phrase.decode(), -a, l, r, n[lang], -score)
        for lang, items in by_lang.items()
        for rank, (score, a, phrase, l, r) in enumerate(sorted(items)[:top], 1)
    }


def mined(spark, rows, **settings):
    docs = spark.createDataFrame(rows, "text string, lang string")
    return [tuple(r) for r in collocations(docs, **settings).collect()]


def test_query_equals_sql_and_brute_force(spark):
    result = [tuple(r) for r in queries()["op12_collocations"](spark, MEDIUM).collect()]
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{MEDIUM}/documents.parquet'")
        expected = connection.sql(sql.oracle_sql()["op12_collocations"]).fetchall()
        rows = connection.sql("SELECT text, lang FROM documents").fetchall()
    assert len(result) > 100
    assert sorted(result) == sorted(expected)
    assert set(result) == brute(rows, 30)


ROWS = [
    ("New York, new york! NEW  YORK\tcity of new york", "en"),
    ("the city of new york. the city of new york the city", "en"),
    ("el el el el el el\x0bel el", "es"),
    ("a b c d e a b c d e a b c d e", None),
    ("a b c d e", "und"),
    (None, "en"),
    ("", None),
    (" . , ", "en"),
    ("É é É é É é \x00 \x85 \x00 \x85", "fr"),
]


@pytest.mark.parametrize(
    "sizes",
    [
        {},
        {"bucket_words": 2, "chunk_words": 5},
        {"bucket_words": 1, "chunk_words": 3, "fanout": 2},
        {"bucket_words": 8, "chunk_words": 1 << 20, "fanout": 3},
    ],
)
def test_buckets_hot_words_and_rounds_change_nothing(spark, sizes):
    found = mined(spark, ROWS * 3, min_count=3, **sizes)
    assert len(found) == len(set(found))
    assert set(found) == brute(ROWS * 3, 3)


def test_a_passage_in_most_rows(spark):
    rows = [("one passage that most rows repeat and repeat", "en")] * 400 + [(f"row {i} has own words", "en") for i in range(200)]
    assert set(mined(spark, rows, bucket_words=50, chunk_words=40)) == brute(rows, 30)


def test_top_and_ties(spark):
    rows = [(f"{x}{y} {x}{z}", "en") for x in "abc" for y in "de" for z in "fg"] * 4
    assert set(mined(spark, rows, min_count=2, top=5)) == brute(rows, 2, 5)


def test_long_text_empty_table_and_clashing_columns(spark):
    names = "text string, lang string, phrase string, f long, n long, word string, bucket int, words string"
    docs = spark.createDataFrame([("x y " * 50_000, "en", "p", 1, 1, "w", 1, "s")], names)
    assert {tuple(r) for r in collocations(docs).collect()} == brute([("x y " * 50_000, "en")], 30)
    assert collocations(docs.limit(0)).count() == 0


def test_frequent_phrases_equal_counts(spark):
    docs = spark.createDataFrame(ROWS, "text string, lang string")
    phrases, totals = frequent_phrases(docs, min_count=1, bucket_words=3, chunk_words=4, fanout=2)
    f, n = counted(ROWS)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in phrases.collect()} == dict(f)
    assert {r.lang: r.n for r in totals.collect()} == {k: v for k, v in n.items() if v}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abc."), max_size=60), st.integers(1, 4))
def test_quicksort_counts_every_frequent_phrase(signs, least):
    words = words_of(" ".join(signs))
    names = [b"", b"a", b"b", b"c"]
    codes = np.array([names.index(w) if w != b"." else 0 for w in words], np.int32)
    windows = _windows(codes)
    suffixes = Suffixes.of(names, windows, np.ones(windows.shape[1], np.int64))
    found = {tuple(p): n for p, n in quicksort_phrases(suffixes, set(), least)}
    f, _ = counted([(" ".join(signs), "x")])
    assert found == {
        tuple(w.encode() for w in p): n for (_, p), n in f.items() if len(p) > 1 and n >= least
    }


def test_packing_is_lossless():
    names = [b"", b"a", b"bb", b"c\xc3\xa9"]
    codes = np.array([[1, 2, 3, 3], [2, 1, 1, 1], [0, 3, 1, 1], [0, 0, 2, 0]], np.int32)
    suffixes = Suffixes.of(names, codes, np.array([1, 2, 3, 1 << 40]))
    words, unpacked, counts = Suffixes.unpack(*suffixes.pack(np.arange(4)))
    assert [b"", *words] == names
    assert (unpacked == suffixes.codes).all() and (counts == suffixes.counts).all()
