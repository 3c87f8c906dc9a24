"""Start append queries. A checkpoint is required wherever results are kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

MICRO_BATCH = {"processingTime": "5 seconds"}
ALL_AVAILABLE = {"availableNow": True}


def start_table(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append to Parquet, exactly once per checkpoint. The default trigger ends when input is used up."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ALL_AVAILABLE))
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path)


def start_console(
    df: DataFrame, checkpoint: str | None = None, truncate: bool = False, trigger: dict | None = None
) -> StreamingQuery:
    """Print rows as they come; nothing is kept."""
    writer = df.writeStream.format("console").outputMode("append").option("truncate", str(truncate).lower())
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or MICRO_BATCH)).start()


def start_memory(df: DataFrame, name: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep rows in a table on the driver: for tests and small looks only."""
    writer = df.writeStream.format("memory").queryName(name).outputMode("append")
    return writer.trigger(**(trigger or ALL_AVAILABLE)).start()
