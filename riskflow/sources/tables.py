"""Columnar sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One Parquet table of a dataset directory. Columns and filters are pruned into the scan."""
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")
