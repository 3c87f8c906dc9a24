from __future__ import annotations

from collections import Counter

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from riskflow.fixed_values import RAW_COLUMNS
from riskflow.operators.quality import (
    KEPT,
    Rules,
    audit,
    audit_lines,
    blank_fields_to_null,
    clean,
    complete_rows,
    kept_rows,
    missing_by_column,
    profile,
    reject_reasons,
    rejected_rows,
    verdict,
)
from riskflow.sources import read_dated_lines, read_delimited

STRICT = Rules(require_timestamp=True)
SCHEMA = ", ".join(f"{c} string" for c in RAW_COLUMNS)


def as_dict(df):
    return {r[0]: r[1] for r in df.collect()}


def test_fixture_verdicts(spark, raw_file):
    parsed, _ = read_delimited(spark, raw_file)
    audited = audit(parsed, STRICT, width="n_fields", by=("source_date",))
    from_lines = audit_lines(read_dated_lines(spark, raw_file)[0], STRICT, by=("source_date",))
    assert set(audited.collect()) == set(from_lines.select(audited.columns).collect())
    got = {r["tranaction_id"]: (r["verdict"], r["copies"]) for r in audited.collect()}
    assert got == {
        "1": ("kept", 2),
        "2": ("bad_timestamp", 1),
        "3": ("terminal_out_of_range", 1),
        "4": ("terminal_out_of_range", 1),
        "5": ("terminal_out_of_range", 1),
        "6": ("tx_amount_not_positive", 1),
        "7": ("ragged", 1),
        "8": ("blank_field", 1),
        "9": ("blank_field", 1),
        "10": ("kept", 1),
    }
    assert as_dict(reject_reasons(audited)) == {
        "kept": 2,
        "duplicate": 1,
        "bad_timestamp": 1,
        "terminal_out_of_range": 3,
        "tx_amount_not_positive": 1,
        "ragged": 1,
        "blank_field": 2,
    }
    assert rejected_rows(audited).count() == 8


def test_amounts_below_one_are_kept(rows):
    df = rows([("2", "2020-01-02 00:00:00", "17", "42", "0.50", "1", "2")], SCHEMA)
    assert clean(df).count() == 1


def test_bad_time_is_kept_unless_asked(rows):
    df = rows([("2", "2020-01-02 24:00:00", "17", "42", "0.50", "1", "2")], SCHEMA)
    assert clean(df).count() == 1
    assert clean(df, STRICT).count() == 0


def test_profile_names_and_counts(rows):
    row = ("1", "2020-01-02 03:04:05", "17", "42", "12.50", "0", "0")
    data = [row, row, (None,) * 7, ("2", "0", "0", "0", "0", "1", "x"), ("3", "t", "5", "7", "-1", "1", "x")]
    got = as_dict(profile(audit(rows(data, SCHEMA))))
    assert got == {
        "count_all_rows": 5,
        "count_duplicates_rows": 1,
        "count_fraud_rows": 2,
        "count_without_fraud_rows": 3,
        "missings_tx_datetime": 2,
        "missings_customer_id": 2,
        "missings_terminal_id": 2,
        "missings_tx_amount": 1,
        "negative_values_tx_amount": 1,
        "count_null_rows": 1,
        "count_del_rows": 4,
    }


def test_profile_of_nothing(rows):
    assert set(as_dict(profile(audit(rows([], SCHEMA)))).values()) == {0}


def test_blanks_by_type(rows):
    df = rows([("", 1.0, 1), ("a", float("nan"), 2), ("b", 2.0, None), ("c", 3.0, 4)], "s string, d double, i int")
    assert as_dict(missing_by_column(df)) == {"s": 1, "d": 1, "i": 1}
    assert [tuple(r) for r in blank_fields_to_null(df).filter("s is null").collect()] == [(None, 1.0, 1)]
    assert [tuple(r) for r in complete_rows(df).collect()] == [("c", 3.0, 4)]


_field = st.sampled_from([None, "", " ", "0", "1", "12", " 12 ", "999", "1000", "-3", "0.5", "NaN", "abc"])
_time = st.sampled_from([None, "", "2020-01-02 03:04:05", "2020-01-02 24:00:00"])
_row = st.tuples(st.sampled_from(["1", "2"]), _time, _field, _field, _field, _field, _field)


def _number(text):
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def _passes(row):
    _, _, customer, terminal, amount, _, _ = row
    whole = _number(terminal)
    if any(v is None or v.strip() == "" or v == "NaN" for v in row):
        return False
    return (
        whole is not None
        and whole == int(whole)
        and 1 <= whole <= 999
        and (_number(amount) or 0) > 0
        and (_number(customer) or 0) > 0
    )


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(_row, max_size=40))
def test_cleaning_properties(spark, data):
    raw = spark.createDataFrame(data, SCHEMA)
    cleaned = clean(raw)
    got = Counter(tuple(r) for r in cleaned.collect())
    assert got == Counter(dict.fromkeys((r for r in data if _passes(r)), 1))
    audited = audit(raw)
    assert Counter(tuple(r) for r in kept_rows(audited).collect()) == got
    assert (audited.agg(F.sum("copies")).first()[0] or 0) == len(data)
    assert sum(as_dict(reject_reasons(audited)).values()) == len(data)
    assert Counter(tuple(r) for r in clean(cleaned).collect()) == got
    assert cleaned.filter(verdict() != KEPT).count() == 0
