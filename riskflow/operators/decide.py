"""Decisions on scored transactions: tiers, lists with a lifetime, credit holds and service goals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskflow.fixed_values import (
    DEVICE_LISTING_DAYS,
    FAST_CREDIT_HOLD_DAYS,
    FAST_CREDIT_SECONDS,
    LABEL,
    MAX_FALSE_ALARM_SHARE,
    MAX_MISSED_LOSS,
    MAX_MISSED_SHARE,
)
from riskflow.functions import ratio
from riskflow.operators.joins import attach_list, small_enough
from riskflow.session import materialize


def decision(score: Column, review_from: float, reject_from: float) -> Column:
    """``green`` passes, ``yellow`` goes to an analyst, ``red`` is declined."""
    return F.when(score >= reject_from, "red").when(score >= review_from, "yellow").otherwise("green")


def listed_periods(
    listings: DataFrame,
    key: str,
    listed_at: str = "listed_at",
    days: int | None = DEVICE_LISTING_DAYS,
    months: int | None = None,
) -> DataFrame:
    """When listings are in force: (key, month, first_day, end), a row per listing and month it touches.

    A list is refreshed once a day, so days are its resolution. A listing covers its own day and those
    until ``days`` days (or ``months`` months) later, the last one excluded. Repeated listings of one key
    and day are merged first. Each listing is then cut where the key's next one starts, so that no day is
    covered twice and a key has at most 31 rows a month.
    """
    start = F.col("first_day")
    end = F.add_months(start, months) if months else F.date_add(start, days)
    following = F.lead("first_day").over(Window.partitionBy(key).orderBy("first_day"))
    touched = F.sequence(F.trunc(start, "month"), F.date_sub("end", 1), F.expr("interval 1 month"))
    return (
        listings.select(key, F.to_date(listed_at).alias("first_day"))
        .distinct()
        .withColumn("end", F.least(end, following))
        .filter(F.col("end") > F.col("first_day"))
        .select(key, F.explode(touched).alias("month"), "first_day", "end")
    )


def blacklisted(
    transactions: DataFrame, active: DataFrame, key: str, at: str = "tx_datetime", how: str = "left_semi"
) -> DataFrame:
    """Transactions made on a day their key is listed; ``left_anti`` gives the others.

    ``active`` comes from ``listed_periods``. The month is part of the equality key, so a busy key is spread over
    its months, and the exact days are tested on the few rows that meet there.
    """
    stored = materialize(
        active.select(
            F.col(key).alias("_key"), F.col("month").alias("_month"), F.col("first_day").alias("_from"), F.col("end").alias("_end")
        ),
        "lookup",
    )
    day = F.to_date(at)
    listed = (
        (F.col(key) == F.col("_key"))
        & (F.trunc(day, "month") == F.col("_month"))
        & (day >= F.col("_from"))
        & (day < F.col("_end"))
    )
    return transactions.join(F.broadcast(stored) if small_enough(stored) else stored, listed, how)


def whitelisted(
    decided: DataFrame, organisations: DataFrame, key: str, column: str = "decision"
) -> DataFrame:
    """Never hold a payment to a listed organisation: its decision becomes ``green``."""
    known = organisations.select(key).distinct().withColumn("_listed", F.lit(True))
    return (
        attach_list(decided, known, [key], "left")
        .withColumn(column, F.when(F.col("_listed"), F.lit("green")).otherwise(F.col(column)))
        .drop("_listed")
    )


def average_fraud_amount(
    transactions: DataFrame, amount: str = "tx_amount", label: str = LABEL
) -> DataFrame:
    fraud = F.col(label) == 1
    return transactions.agg(
        F.count_if(fraud).alias("n_fraud"), F.avg(F.when(fraud, F.col(amount))).alias("avg_fraud_amount")
    )


def fast_credits(
    applications: DataFrame,
    credits: DataFrame,
    client: str,
    at: str = "at",
    seconds: tuple[int, int] = FAST_CREDIT_SECONDS,
) -> DataFrame:
    """Credits issued within the given span after an application of the same client.

    Both inputs are (client, at) and are laid on one time line per client, cut into slots as long as the span.
    Each application is in its own slot and, if it reaches there, in the next, which makes every slot complete
    in itself: a busy client is many small groups instead of one, and a sliding count finds the pairs without
    forming them. Rows without a client or a time match nothing.
    """
    near, far = (bound * 1_000_000 for bound in seconds)
    slot = max(far, 1)
    micros = F.unix_micros(F.col(at))
    known = F.col(client).isNotNull() & F.col(at).isNotNull()
    applications, credits = applications.filter(known), credits.filter(known)
    ends = F.array(F.floor(F.col("micros") / slot), F.floor((F.col("micros") + far) / slot))
    asked = applications.select(client, F.col(at), micros.alias("micros"), F.lit(1).alias("asked"))
    asked = asked.withColumn("slot", F.explode(F.array_distinct(ends)))
    issued = credits.select(
        client,
        F.col(at),
        micros.alias("micros"),
        F.lit(0).alias("asked"),
        F.floor(micros / slot).alias("slot"),
    )
    span = Window.partitionBy(client, "slot").orderBy("micros").rangeBetween(-far, -near)
    return (
        asked.unionByName(issued)
        .withColumn("applications", F.sum("asked").over(span))
        .filter((F.col("asked") == 0) & (F.col("applications") > 0))
        .select(client, at)
    )


def held_after_fast_credit(
    transactions: DataFrame,
    fast: DataFrame,
    client: str,
    at: str = "tx_datetime",
    credit_at: str = "at",
    hold_days: int = FAST_CREDIT_HOLD_DAYS,
) -> DataFrame:
    """Transactions with ``held``: true within ``hold_days`` whole days after a fast credit.

    Per client and day the holds shrink to two times: held from the first credit of that day on, and
    until the end of the hold of the last credit whose hold runs out that day. On days in between the
    whole day is held. So the join has at most one row per client and day and compares no pairs.
    """
    day_of = F.to_date(F.col(credit_at))
    spread = fast.select(
        client,
        F.col(credit_at),
        day_of.alias("issued_day"),
        F.explode(F.sequence(day_of, F.date_add(day_of, hold_days))).alias("day"),
    )
    first_day = F.col("day") == F.col("issued_day")
    last_day = F.col("day") == F.date_add("issued_day", hold_days)
    bounds = spread.groupBy(client, "day").agg(
        F.min(F.when(first_day, F.col(credit_at))).alias("_held_from"),
        F.max(F.when(last_day, F.col(credit_at) + F.make_dt_interval(F.lit(hold_days)))).alias("_held_until"),
        F.max(~first_day & ~last_day).alias("_held_all_day"),
    )
    held = (
        F.coalesce(F.col("_held_all_day"), F.lit(False))
        | F.coalesce(F.col(at) > F.col("_held_from"), F.lit(False))
        | F.coalesce(F.col(at) <= F.col("_held_until"), F.lit(False))
    )
    keyed = transactions.withColumn("_hold_day", F.to_date(at))
    return (
        attach_list(keyed, bounds.withColumnRenamed("day", "_hold_day"), [client, "_hold_day"], "left")
        .withColumn("held", held)
        .drop("_hold_day", "_held_from", "_held_until", "_held_all_day")
    )


def service_goals(
    predictions: DataFrame,
    at: str = "tx_datetime",
    amount: str = "tx_amount",
    label: str = LABEL,
    by: Sequence[str] = (),
) -> DataFrame:
    """Per month: shares of missed frauds and false alarms among all operations, the loss by missed
    frauds, and whether each goal is met."""
    missed = (F.col(label) == 1) & (F.col("prediction") == 0)
    alarm = (F.col(label) == 0) & (F.col("prediction") == 1)
    n = F.count(F.lit(1))
    monthly = predictions.groupBy(*by, F.date_format(at, "yyyy-MM").alias("month")).agg(
        n.alias("n"),
        ratio(F.count_if(missed), n).alias("missed_share"),
        ratio(F.count_if(alarm), n).alias("false_alarm_share"),
        F.coalesce(F.sum(F.when(missed, F.col(amount))), F.lit(0.0)).alias("missed_loss"),
    )
    return monthly.withColumns(
        {
            "missed_ok": F.col("missed_share") <= MAX_MISSED_SHARE,
            "false_alarm_ok": F.col("false_alarm_share") <= MAX_FALSE_ALARM_SHARE,
            "loss_ok": F.col("missed_loss") < MAX_MISSED_LOSS,
        }
    )
