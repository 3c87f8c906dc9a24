"""Tests and conversions of single values. Dirty text never raises: every cast is a ``try`` cast."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from riskflow.fixed_values import TIMESTAMP_FORMAT


def is_blank(column: Column, data_type: T.DataType | None = None) -> Column:
    """True for null, NaN (a number or the text ``NaN``) and text of spaces only; never null."""
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return column.isNull() | F.isnan(column)
    if data_type is None or isinstance(data_type, T.StringType):
        return column.isNull() | _reads_as_nan(column) | (F.trim(column) == "")
    return column.isNull()


def _reads_as_nan(text: Column) -> Column:
    """The cast of other text than numbers raises and catches an error inside Spark, which costs more than
    all other tests of a row; so only text that could be NaN is cast. The search for one letter goes
    first, because it copies nothing. A branch, not ``&``, keeps the cast from being computed ahead as an
    expression common to several tests."""
    has_letter = text.contains("a") | text.contains("A")
    spelled = F.when(has_letter, F.lower(text).contains("nan")).otherwise(False)
    return F.when(spelled, F.isnan(text.try_cast("double"))).otherwise(False)


def blank_to_null(column: Column, data_type: T.DataType | None = None) -> Column:
    """The value itself, untrimmed, or null where it is blank."""
    return F.when(~is_blank(column, data_type), column)


def zero_value(column: Column) -> Column:
    """True where the value reads as the number zero; false for null and other text.

    Zero is spelled with a blank, a sign, ``.`` or ``0`` in front, all of which sort before ``1``; other
    text is not cast (see ``_reads_as_nan``).
    """
    could_be = column.cast("string") < "1"
    return F.coalesce(F.when(could_be, column.try_cast("double") == 0), F.lit(False))


def missing_or_zero(column: Column) -> Column:
    return column.isNull() | zero_value(column)


def parse_timestamp(column: Column, pattern: str = TIMESTAMP_FORMAT) -> Column:
    """Null for text that is no such time, for example hour 24."""
    return F.try_to_timestamp(column, F.lit(pattern))


def ratio(numerator: Column, denominator: Column, undefined: float | None = None) -> Column:
    """Quotient as double; ``undefined`` where the denominator is zero."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return quotient if undefined is None else F.coalesce(quotient, F.lit(float(undefined)))


def percent_of(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part, whole) * 100, digits)
