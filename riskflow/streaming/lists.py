"""Decisions on a stream by a list that is refreshed while the stream runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from riskflow.sinks.versions import read_version, versions
from riskflow.streaming.batches import start_batches

LIST_VERSION = "list_version"


def start_with_list(
    stream: DataFrame,
    list_path: str,
    decide: Callable[[DataFrame, DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """``decide`` on each batch with the list as it is when the batch starts; the version stands beside every row.

    The list is a versioned table (``sinks.versions``): refreshing it is publishing a version, which no running
    batch sees and every later one does. A batch that is run again takes the version current then, for all its rows.
    """

    def judge(batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        current = max(versions(spark, list_path))
        listed = read_version(spark, list_path, current)
        return decide(batch, listed).withColumn(LIST_VERSION, F.lit(current))

    return start_batches(stream, judge, target, checkpoint, trigger=trigger)
