"""Parquet and text sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def write_table(
    df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = ()
) -> str:
    """Write Parquet to any URI Spark can reach; fails if the target exists unless told otherwise."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_clean(df: DataFrame, path: str) -> str:
    return write_table(df, path, "overwrite")


def write_report_text(report: DataFrame, path: str, name: str = "metric", value: str = "value") -> str:
    """A report of a few lines as text, ``name value`` per line, in one file."""
    line = F.concat_ws(" ", F.col(name), F.col(value).cast("string"))
    report.select(line.alias("value")).coalesce(1).write.mode("overwrite").text(path)
    return path
