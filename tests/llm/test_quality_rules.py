from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from conftest import MEDIUM
from riskflow.llm import quality
from riskflow.llm.queries import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    counts = (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )
    return (*counts, counts[0] < 10 or 100 * counts[4] > 20 * counts[0])


@pytest.fixture(scope="module")
def verdicts(spark):
    return queries()["op2_quality"](spark, MEDIUM).toPandas().set_index("doc_id")


def test_base_counts_equal_brute_force(spark, verdicts):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()
    assert len(docs) == len(verdicts)
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for doc_id, text in docs:
        assert tuple(verdicts.loc[doc_id, columns]) == base(text)


def test_verdicts_follow_labels(spark, verdicts):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").toPandas().set_index("doc_id")
    both = verdicts.join(labels, how="inner")
    passed = both[~both.base_failed]
    assert passed[passed.quality == 1].kept.mean() > 0.99
    assert passed[passed.quality == 0].kept.mean() < 0.2
    assert not verdicts[verdicts.base_failed].kept.any()


def test_score_equals_definition(spark):
    texts = ["a b c d e f g h i j", "a b a b c d e f g h", "x y z x y q r s t u", None, "a", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 1), (2, 0), (None, 1)], "doc_id long, quality int")
    rows = {r.doc_id: r for r in quality.quality_verdicts(docs, labels, buckets=1 << 20).collect()}
    grams = {i: (WORD.findall(t or ""),) for i, t in enumerate(texts)}
    grams = {i: (w, list(zip(w, w[1:]))) for i, (w,) in grams.items()}
    raw = [Counter(g for i in grams for g in grams[i][k]) for k in (0, 1)]
    good = [Counter(g for i in (0, 1) for g in grams[i][k]) for k in (0, 1)]
    for i in range(3):
        total = 0.0
        for k in (0, 1):
            share = good[k].total() / raw[k].total()
            total += sum(math.log((good[k][g] + 5) / (raw[k][g] * share + 5)) for g in grams[i][k])
        assert rows[i].score == pytest.approx(total / (len(grams[i][0]) + len(grams[i][1])))
    assert rows[3].score is None and not rows[3].kept and rows[3].n_words == 0


def test_edge_cases(spark):
    texts = [None, "", " \n\t ", "a " * 30000, "é\x0bü ñ", "same\nsame\n \n \nsame", "1 2 3 4 5 1 2 3 4 5", "a b c"]
    data = [(i, t, "z", True) for i, t in enumerate(texts)] + [(0, "dup", "z", True), (None, "n", "z", True)]
    docs = spark.createDataFrame(data, "doc_id long, text string, words string, kept boolean")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    found = quality.quality_verdicts(docs, labels)
    assert found.count() == len(data)
    for r in found.collect():
        if r.doc_id is not None and r.doc_id > 0:
            assert tuple(r)[1:7] == base(texts[r.doc_id])
    assert quality.quality_verdicts(docs.limit(0), labels).count() == 0


def test_plan_has_no_python(spark):
    plan = queries()["op2_quality"](spark, MEDIUM)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
