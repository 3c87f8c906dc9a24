"""Number to label by edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from riskflow.fixed_values import (
    RISK_BUCKET_ABOVE,
    RISK_BUCKET_NAN,
    RISK_BUCKET_NULL,
    RISK_BUCKETS,
)


def bucket(
    column: Column,
    edges: Sequence[tuple[float, bool, str]],
    above: str,
    null_label: str | None = None,
    nan_label: str | None = None,
) -> Column:
    """Label of the first edge the value lies under.

    ``edges`` are (upper edge, edge included, label) in ascending order. Spark sorts NaN above every
    number, so NaN is tested before any edge.
    """
    if list(edges) != sorted(edges, key=lambda edge: edge[0]):
        raise ValueError("edges must ascend")
    chain = F.when(column.isNull(), F.lit(null_label)).when(F.isnan(column), F.lit(nan_label))
    for upper, included, label in edges:
        under = column <= upper if included else column < upper
        chain = chain.when(under, F.lit(label))
    return chain.otherwise(F.lit(above))


def risk_bucket(percent: Column) -> Column:
    """Bucket of a terminal's fraud percentage."""
    return bucket(percent, RISK_BUCKETS, RISK_BUCKET_ABOVE, RISK_BUCKET_NULL, RISK_BUCKET_NAN)
