"""Streaming operators that keep state, each bounded by a watermark.

Rows that come later than the watermark allows, ``delay`` behind the latest time seen, are left out by Spark and
counted in the query's progress; rows without a time are left out as well. State lives in Spark's state store
under the checkpoint, so a query that is started again goes on where it was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskflow.fixed_values import FAST_CREDIT_SECONDS

DELAY = "1 hour"


def _seconds(n: int) -> Column:
    """An interval as a literal: only then does Spark see how far back the state must reach."""
    return F.expr(f"INTERVAL '{n}' SECOND")


def fast_credit_stream(
    applications: DataFrame,
    credits: DataFrame,
    client: str,
    at: str = "at",
    seconds: tuple[int, int] = FAST_CREDIT_SECONDS,
    delay: str = DELAY,
) -> DataFrame:
    """Credits issued within the given span after an application of the same client, while both arrive.

    The stream's form of ``decide.fast_credits``, with all columns of the credits; a credit comes out once,
    as soon as its first application is known. Applications are laid into time slots as long as the span, each
    in its own and in the next, so the state of a busy client is spread over many keys. Both sides wait for
    each other by their watermarks, and state older than that is dropped.
    """
    near, far = seconds
    slot = max(far, 1)
    asked_at = F.col("_asked")
    slots = F.array_distinct(
        F.array(F.floor(F.unix_seconds(asked_at) / slot), F.floor(F.unix_seconds(asked_at + _seconds(far)) / slot))
    )
    asked = (
        applications.select(F.col(client).alias("_client"), F.col(at).alias("_asked"))
        .withWatermark("_asked", delay)
        .select("_client", "_asked", F.explode(slots).alias("_slot"))
    )
    issued = credits.withWatermark(at, delay).withColumn("_in", F.floor(F.unix_seconds(at) / slot))
    paired = (
        (F.col(client) == F.col("_client"))
        & (F.col("_in") == F.col("_slot"))
        & (F.col(at) >= asked_at + _seconds(near))
        & (F.col(at) <= asked_at + _seconds(far))
    )
    return issued.join(asked, paired, "left_semi").drop("_in")


def window_counts(
    rows: DataFrame,
    at: str,
    length: str,
    by: Sequence[str] = (),
    amount: str | None = None,
    delay: str = DELAY,
    slide: str | None = None,
) -> DataFrame:
    """Rows and, if asked for, the sum of ``amount`` per window of event time: (window_start, window_end, by, n, total).

    In append mode a window comes out once, when the watermark has passed its end; the last ones wait for later rows.
    Windows tumble unless ``slide`` is given. Counts are summed per task before they are shuffled.
    """
    measures = [F.count(F.lit(1)).alias("n"), *([F.sum(amount).alias("total")] if amount else [])]
    window = F.window(at, length, slide) if slide else F.window(at, length)
    return (
        rows.withWatermark(at, delay)
        .groupBy(window.alias("window"), *by)
        .agg(*measures)
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *by,
            "n",
            *(["total"] if amount else []),
        )
    )


def dedupe_stream(rows: DataFrame, keys: Sequence[str], at: str, delay: str = DELAY) -> DataFrame:
    """The first of rows that agree in ``keys``, also across files and days, if they come within ``delay``.

    The state holds a key for that long. What is delivered again later than that comes out once more if its time is
    still within the watermark, and is left out as late if it is not. Null keys agree with each other.
    """
    timed = rows.filter(F.col(at).isNotNull())
    return timed.withWatermark(at, delay).dropDuplicatesWithinWatermark(list(keys))
