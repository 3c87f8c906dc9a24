"""Column expressions: all built from native functions, so they stay inside generated code."""

from riskflow.functions.buckets import bucket, risk_bucket
from riskflow.functions.hashing import hash_slice, poisson_drawn, poisson_weight, split_index
from riskflow.functions.student import two_sided_p, t_critical
from riskflow.functions.values import (
    blank_to_null,
    is_blank,
    missing_or_zero,
    parse_timestamp,
    percent_of,
    ratio,
    zero_value,
)

__all__ = [
    "blank_to_null",
    "bucket",
    "hash_slice",
    "is_blank",
    "missing_or_zero",
    "parse_timestamp",
    "percent_of",
    "poisson_drawn",
    "poisson_weight",
    "ratio",
    "risk_bucket",
    "split_index",
    "t_critical",
    "two_sided_p",
    "zero_value",
]
