"""Cleaning rules, the reason a row is rejected, and the profile of a raw table.

Everything about a raw table follows from its distinct rows and how many copies each has. ``audit``
computes that with one shuffle, counting copies before rows move, so a row repeated a billion times
travels once per task. The profile, the clean set and the rejected set all read the audit.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from riskflow.fixed_values import (
    LABEL,
    MISSING_NUMERIC_COLUMNS,
    MISSING_TEXT_COLUMNS,
    PROFILE_ALL,
    PROFILE_BLANK,
    PROFILE_DUPLICATES,
    PROFILE_FRAUD,
    PROFILE_LEGITIMATE,
    PROFILE_MISSING,
    PROFILE_NEGATIVE,
    PROFILE_REMOVED,
    RAW_COLUMNS,
    TERMINAL_RANGE,
)
from riskflow.functions import blank_to_null, is_blank, missing_or_zero, parse_timestamp, zero_value
from riskflow.sources.text import parse_lines

KEPT = "kept"


@dataclass(frozen=True)
class Rules:
    """What a kept transaction satisfies. Numbers are cast before they are compared."""

    columns: tuple[str, ...] = RAW_COLUMNS
    terminal: str = "terminal_id"
    terminal_range: tuple[int, int] = TERMINAL_RANGE
    positive: tuple[str, ...] = ("tx_amount", "customer_id")
    timestamp: str = "tx_datetime"
    require_timestamp: bool = False
    whole: tuple[str, ...] = ("customer_id",)
    binary: tuple[str, ...] = (LABEL,)


def _in_range(rules: Rules) -> Column:
    return F.col(rules.terminal).try_cast("int").between(*rules.terminal_range)


def _positive(column: str) -> Column:
    return F.col(column).try_cast("double") > 0


def _any_blank(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [is_blank(F.col(c)) for c in columns])


def verdict(rules: Rules = Rules(), width: str | None = None, fits: str | None = None) -> Column:
    """``kept`` or the first rule a row breaks.

    ``width`` names a field-count column and ``fits`` one that tells whether the row's file has the expected
    columns, if there are such. Whole and binary columns must be readable as what they are stored as.
    """
    checks: list[tuple[str, Column]] = []
    if fits:
        checks.append(("other_columns", F.col(fits)))
    if width:
        checks.append(("ragged", F.col(width) == len(rules.columns)))
    checks.append(("terminal_out_of_range", _in_range(rules)))
    checks += [(f"{c}_not_positive", _positive(c)) for c in rules.positive]
    checks.append(("blank_field", ~_any_blank(rules.columns)))
    checks += [(f"{c}_unreadable", F.col(c).try_cast("bigint").isNotNull()) for c in rules.whole]
    checks += [(f"{c}_not_0_or_1", F.col(c).try_cast("int").isin(0, 1)) for c in rules.binary]
    if rules.require_timestamp:
        checks.append(("bad_timestamp", parse_timestamp(F.col(rules.timestamp)).isNotNull()))
    broken = [F.when(~F.coalesce(passes, F.lit(False)), F.lit(name)) for name, passes in checks]
    return F.coalesce(*broken, F.lit(KEPT))


def clean(raw: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Distinct rows that satisfy every rule, still as text.

    All row tests run before the shuffle of ``distinct``; testing for blanks first changes nothing,
    because it never alters a kept value.
    """
    return raw.filter(verdict(rules) == KEPT).select(*rules.columns).distinct()


def blank_fields_to_null(df: DataFrame) -> DataFrame:
    """Every column with blank values as null; what is blank depends on the column's type."""
    return df.select(*[blank_to_null(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def complete_rows(df: DataFrame) -> DataFrame:
    """Rows without any blank value."""
    return blank_fields_to_null(df).na.drop("any")


def audit(
    raw: DataFrame, rules: Rules = Rules(), width: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Distinct raw rows with ``copies`` and ``verdict``; rows of different ``by`` values stay apart."""
    keys = [*by, *rules.columns, *([width] if width else [])]
    copies = raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return copies.withColumn("verdict", verdict(rules, width))


def audit_lines(lines: DataFrame, rules: Rules = Rules(), by: Sequence[str] = ()) -> DataFrame:
    """The audit of text lines (``value``) without header, with the field count as ``n_fields``.

    Lines are equal exactly when all their fields are, so they are counted before they are split: the
    shuffle carries one text per row instead of one per field, and only distinct lines are parsed. A rejected
    row keeps its whole line as ``line``, so that nothing of it is lost. Lines with a column ``fits`` are
    rejected where it is false.
    """
    fits = [c for c in ("fits",) if c in lines.columns]
    copies = lines.groupBy(*by, *fits, "value").agg(F.count(F.lit(1)).alias("copies"))
    parsed = parse_lines(copies, rules.columns, keep=(*by, *fits, "copies", "value"))
    judged = parsed.withColumn("verdict", verdict(rules, "n_fields", *fits))
    return judged.withColumn("line", F.when(F.col("verdict") != KEPT, F.col("value"))).drop("value", *fits)


def kept_rows(audited: DataFrame, rules: Rules = Rules(), by: Sequence[str] = ()) -> DataFrame:
    """The clean set of an audit; equals ``clean`` of the raw table."""
    return audited.filter(F.col("verdict") == KEPT).select(*by, *rules.columns)


def rejected_rows(audited: DataFrame) -> DataFrame:
    """The quarantine: distinct rejected rows, each with its reason and number of copies."""
    return audited.filter(F.col("verdict") != KEPT).withColumnRenamed("verdict", "reason")


def reject_reasons(audited: DataFrame) -> DataFrame:
    """Rows by reason (reason, n). Copies of kept rows beyond the first are ``duplicate``."""
    by_verdict = audited.groupBy("verdict").agg(
        F.sum("copies").alias("n"), F.count(F.lit(1)).alias("distinct_rows")
    )
    kept = F.col("verdict") == KEPT
    lines = F.when(
        kept,
        F.array(
            F.struct(F.lit(KEPT).alias("reason"), F.col("distinct_rows").alias("n")),
            F.struct(F.lit("duplicate").alias("reason"), (F.col("n") - F.col("distinct_rows")).alias("n")),
        ),
    ).otherwise(F.array(F.struct(F.col("verdict").alias("reason"), F.col("n").alias("n"))))
    return by_verdict.select(F.inline(lines)).filter(F.col("n") > 0)


def profile(
    audited: DataFrame,
    rules: Rules = Rules(),
    text_columns: Sequence[str] = MISSING_TEXT_COLUMNS,
    numeric_columns: Sequence[str] = MISSING_NUMERIC_COLUMNS,
) -> DataFrame:
    """Profile of the raw table as (metric, value): every count in one aggregate over the audit."""
    copies = F.col("copies")

    def rows_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, copies)), F.lit(0)).cast("bigint")

    all_rows = F.coalesce(F.sum(copies), F.lit(0)).cast("bigint")
    fraud = rows_where(F.col("tx_fraud").try_cast("int") == 1)
    measures = {
        PROFILE_ALL: all_rows,
        PROFILE_DUPLICATES: all_rows - F.count(F.lit(1)),
        PROFILE_FRAUD: fraud,
        PROFILE_LEGITIMATE: all_rows - fraud,
    }
    for column in rules.columns:
        if column in text_columns:
            measures[PROFILE_MISSING.format(column=column)] = rows_where(missing_or_zero(F.col(column)))
        if column in numeric_columns:
            measures[PROFILE_MISSING.format(column=column)] = rows_where(zero_value(F.col(column)))
    for column in numeric_columns:
        measures[PROFILE_NEGATIVE.format(column=column)] = rows_where(F.col(column).try_cast("double") < 0)
    measures[PROFILE_BLANK] = rows_where(_any_blank(rules.columns))
    measures[PROFILE_REMOVED] = all_rows - F.count_if(F.col("verdict") == KEPT)
    counts = audited.agg(*[value.cast("bigint").alias(name) for name, value in measures.items()])
    return counts.unpivot([], list(measures), "metric", "value")


def missing_by_column(df: DataFrame) -> DataFrame:
    """Blank values of every column as (column, missing), by the column's type; one pass."""
    counts = df.agg(
        *[F.count_if(is_blank(F.col(f.name), f.dataType)).alias(f.name) for f in df.schema.fields]
    )
    return counts.unpivot([], df.columns, "column", "missing")
