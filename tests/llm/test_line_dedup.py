from __future__ import annotations

import hashlib
import string
from collections import defaultdict

import duckdb

from conftest import MEDIUM, SMALL
from riskflow.llm import sql
from riskflow.llm.line_dedup import deduplicate_lines
from riskflow.llm.queries import queries

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows, min_chars=20, min_docs=3):
    """rows: (id, text); per row: (id, lines, dropped, text that stays)."""
    split = [(i, (t or "").split("\n")) for i, t in rows]
    keys = [[line.strip(" \t\n\x0b\x0c\r").translate(FOLD) for line in lines] for _, lines in split]
    holders = defaultdict(set)
    for n, found in enumerate(keys):
        for key in found:
            if len(key) >= min_chars:
                holders[key].add(n)
    shared = {k: v for k, v in holders.items() if len(v) >= min_docs}
    least = (False, 0)
    order = {n: (i is not None, i or 0) for n, (i, _) in enumerate(split)}
    out = []
    for n, (i, lines) in enumerate(split):
        kept = [
            line
            for line, key in zip(lines, keys[n])
            if key not in shared or order[n] == max((order[m] for m in shared[key]), default=least)
        ]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def check(spark, data, **settings):
    docs = spark.createDataFrame(data, "doc_id long, text string")
    found = [tuple(r) for r in deduplicate_lines(docs, **settings).collect()]
    assert sorted(found, key=repr) == sorted(brute(data, **settings), key=repr)


def test_query_equals_sql_and_brute_force(spark):
    result = queries()["op13_line_dedup"](spark, MEDIUM).collect()
    with duckdb.connect() as connection:
        connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{MEDIUM}/documents.parquet'")
        expected = connection.sql(sql.oracle_sql()["op13_line_dedup"]).fetchall()
    assert sorted(map(tuple, result)) == sorted(expected)
    docs = [tuple(r) for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()]
    digests = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(docs)]
    assert sorted(digests) == sorted(expected)
    assert sum(r.n_dropped for r in result) > 0


def test_small_cases(spark):
    long = "a line of more than twenty signs"
    check(
        spark,
        [
            (1, f"{long}\nown"),
            (2, f"  {long.upper()}\t\r\nother\n"),
            (3, f"{long}\n{long}\nx"),
            (4, f"short\n{'é' * 20}\n{'é' * 19}"),
            (5, f"short\n{'É' * 20}\n{'é' * 20}"),
            (6, f"short\n{'é' * 20}\x0b\n\n"),
            (7, None),
            (8, ""),
            (9, "\n\n" + " " * 40),
        ],
    )


def test_null_ids_ties_and_repeated_rows(spark):
    line = "the same line in many documents"
    check(spark, [(None, line), (None, line), (None, line + "\nx")])
    check(spark, [(None, line), (1, line), (1, line), (1, "y\n" + line)])
    check(spark, [(5, line)] * 4 + [(4, f"{line}\n{line}")] * 3 + [(None, f"a\n{line}")])
    check(spark, [(1, line), (2, line)])


def test_long_text_with_many_dropped_lines_is_linear(spark):
    body = "\n".join(f"line number {i} of a very long text" for i in range(60_000))
    check(spark, [(1, body), (2, body), (3, body + "\nend")])


def test_empty_table_and_clashing_columns(spark):
    names = "doc_id long, text string, id long, print long, keys string, dropped string, lines int, k1 int, lost_id int"
    docs = spark.createDataFrame([(1, "x", 1, 1, "k", "d", 1, 1, 1)], names)
    assert [tuple(r) for r in deduplicate_lines(docs).collect()] == [(1, 1, 0, "x")]
    assert deduplicate_lines(docs.limit(0)).count() == 0


def test_other_limits(spark):
    check(spark, [(1, "ab\ncd"), (2, "AB\nef"), (3, "x")], min_chars=2, min_docs=2)


def test_plan_is_native(spark):
    plan = queries()["op13_line_dedup"](spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
