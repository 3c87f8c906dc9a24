"""JSON messages to columns. The same function serves streams and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskflow.fixed_values import MESSAGE_SCHEMA, TIMESTAMP_FORMAT
from riskflow.functions import parse_timestamp


def decode_messages(messages: DataFrame, schema: str = MESSAGE_SCHEMA) -> DataFrame:
    """``value`` bytes to text, to a struct, to flat columns.

    Broken JSON gives nulls, numbers in text fields become text, unknown fields are left out.
    """
    text = messages.selectExpr("cast(value as string) as value")
    return text.select(F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("value")).select("value.*")


def with_event_time(decoded: DataFrame, column: str = "ts", pattern: str = TIMESTAMP_FORMAT) -> DataFrame:
    """Text time to ``event_time``; null where it cannot be read."""
    return decoded.withColumn("event_time", parse_timestamp(F.col(column), pattern))
