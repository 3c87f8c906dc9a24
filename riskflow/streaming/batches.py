"""Streams whose batches are handled as tables, each with exactly one effect on the target.

A batch is written to a folder of its own, named by its id and replaced as a whole. The checkpoint gives a batch
that is run again the same input, so a restart in the middle of one writes nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from riskflow.streaming.queries import ALL_AVAILABLE

BATCH = "batch"


def start_batches(
    df: DataFrame,
    result: Callable[[DataFrame, int], DataFrame | None],
    target: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write ``result`` of every batch to Parquet, once per checkpoint; nothing is written where it is None."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = result(batch, batch_id)
        if rows is not None:
            rows.write.mode("overwrite").parquet(
                f"{target}/{BATCH}={batch_id}", partitionBy=list(partition_by) or None
            )

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or ALL_AVAILABLE)).start()


def read_batches(spark: SparkSession, target: str, schema: object = None) -> DataFrame:
    """All rows that batches have written, without the batch they came with."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.option("basePath", target).parquet(f"{target}/{BATCH}=*").drop(BATCH)
