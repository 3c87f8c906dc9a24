"""Typed transaction columns and the risk of each terminal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riskflow.fixed_values import (
    TERMINAL_BUCKET,
    TERMINAL_FRAUD,
    TERMINAL_PERCENT,
    TERMINAL_TOTAL,
    TIMESTAMP_FORMAT,
)
from riskflow.functions import parse_timestamp, percent_of, risk_bucket
from riskflow.operators.joins import attach_list, attach_stored


def typed(cleaned: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Clean text columns to types, with the hour and the columns to ``keep`` as they are. A time that
    cannot be read becomes null."""
    moment = parse_timestamp(F.col("tx_datetime"))
    return cleaned.select(
        "tranaction_id",
        moment.alias("tx_datetime"),
        F.col("customer_id").try_cast("bigint").alias("customer_id"),
        F.col("terminal_id").try_cast("int").alias("terminal_id"),
        F.col("tx_amount").try_cast("double").alias("tx_amount"),
        F.col("tx_fraud").try_cast("int").alias("tx_fraud"),
        "tx_fraud_scenario",
        F.hour(moment).alias("hour_tx_datetime"),
        *keep,
    )


def formatted_time(df: DataFrame, column: str = "tx_datetime") -> DataFrame:
    """Timestamp back to text, for sinks that want it so."""
    return df.withColumn(column, F.date_format(column, TIMESTAMP_FORMAT))


def terminal_profile(
    transactions: DataFrame,
    key: str = "terminal_id",
    label: str = "tx_fraud",
    zero_as_null: bool = True,
) -> DataFrame:
    """Transactions, frauds, fraud percentage and risk bucket of each terminal.

    One conditional aggregate, so only two counts per terminal and task are shuffled, however busy a
    terminal is. A terminal without fraud has null counts and the bucket ``Unknown``; with
    ``zero_as_null=False`` it has zero and ``Under 10``.
    """
    fraud = F.count_if(F.col(label) == 1)
    counts = transactions.groupBy(key).agg(
        F.count(F.lit(1)).alias(TERMINAL_TOTAL),
        (F.when(fraud > 0, fraud) if zero_as_null else fraud).alias(TERMINAL_FRAUD),
    )
    percent = percent_of(F.col(TERMINAL_FRAUD), F.col(TERMINAL_TOTAL))
    return counts.withColumn(TERMINAL_PERCENT, percent).withColumn(
        TERMINAL_BUCKET, risk_bucket(F.col(TERMINAL_PERCENT))
    )


def enrich(
    transactions: DataFrame, profiles: DataFrame | None = None, key: str = "terminal_id"
) -> DataFrame:
    """Each transaction with its terminal's profile, whatever keys there are.

    ``profiles`` default to those of the transactions themselves; given ones must be stored.
    """
    if profiles is None:
        return attach_list(transactions, terminal_profile(transactions, key), [key], "left")
    return attach_stored(transactions, profiles, [key], "left")


def fraud_free_terminals(profiles: DataFrame, key: str = "terminal_id") -> DataFrame:
    """Terminals with no fraud: an anti join of terminals with fraudulent ones, as one test."""
    free = F.coalesce(F.col(TERMINAL_FRAUD), F.lit(0)) == 0
    return profiles.filter(free).select(key, TERMINAL_TOTAL)


def first_by(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The ``n`` rows with the smallest keys; ordered, so repeated runs agree."""
    return df.orderBy(key).limit(n)
