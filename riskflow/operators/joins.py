"""Attach a lookup table with one row per key to rows whose keys may be skewed.

A lookup is stored first, so that measuring it and joining it compute it once. It is broadcast if its rows and
its bytes allow; a larger one joins by shuffle. There only the left side can hold a busy key, and as both sides
are shuffled for this join alone, Spark splits the partition of such a key at run time. Either way the left
side is read once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from riskflow.session import materialize

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 8 << 20  # of Parquet files, several times as much in memory


def small_enough(stored: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a stored lookup may be broadcast, by its row count and the size of its files."""
    files = stored.groupBy("_metadata.file_path").agg(
        F.count(F.lit(1)).alias("n"), F.max("_metadata.file_size").alias("size")
    )
    n, bytes_ = files.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0))).head()
    return n <= rows and bytes_ <= size


def attach_stored(left: DataFrame, stored: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Semi, anti or left join of a lookup that has been written already."""
    return left.join(F.broadcast(stored) if small_enough(stored) else stored, list(on), how)


def attach_list(left: DataFrame, lookup: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Semi, anti or left join of a lookup with one row per key."""
    return attach_stored(left, materialize(lookup, "lookup"), on, how)
