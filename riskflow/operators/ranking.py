"""Running totals over a whole table in a given order, without one task or the driver seeing all of it.

Rows are dealt to ranges of the order and stored. A range sums within itself, in parallel; what lies before a
range is the sum of the ranges before it, of which there are as many as tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskflow.session import materialize


def running_totals(
    rows: DataFrame, order: Sequence[Column], total: str, by: Sequence[str] = (), name: str = "before"
) -> DataFrame:
    """``rows`` with ``name``: the sum of ``total`` over the rows that come earlier, within each ``by``.

    ``order`` must tell all rows of a group apart. Null values of ``by`` are a group of their own.
    """
    stored = materialize(rows, "unordered")  # the ranges are drawn from it, then it is read again
    groups = [F.col(c) for c in by]
    ranged = stored.repartitionByRange(*groups, *order).withColumn("_range", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")
    earlier = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*by, "_range").agg(F.sum(total).alias("_sum"))
    starts = sums.select(
        *[F.col(c).alias(f"_of_{c}") for c in by],
        F.col("_range").alias("_in"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"),
    )
    within = Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by], F.col("_range") == F.col("_in"))
    summed = ranged.withColumn("_within", F.coalesce(F.sum(total).over(within), F.lit(0))).join(starts, same)
    return summed.withColumn(name, F.col("_start") + F.col("_within")).select(*rows.columns, name)
