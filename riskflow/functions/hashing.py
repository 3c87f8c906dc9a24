"""Repeatable pseudo-random choices from row ids.

A draw is a fixed-width slice of an MD5 digest in lower-case hexadecimal. Such text sorts like the number
it spells, so a draw is compared with thresholds as text and never converted. The same row gets the same
draw in every run and after every lost executor, which ``rand()`` does not give.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

SLICE_DIGITS = 8
SLICES_PER_DIGEST = 4
_RANGE = 16**SLICE_DIGITS


def digest(columns: Sequence[Column], salt: Column | str = "") -> Column:
    salt = F.lit(salt) if isinstance(salt, str) else salt
    parts = [F.coalesce(column.cast("string"), F.lit("")) for column in columns]
    return F.md5(F.concat_ws(":", *parts, salt.cast("string")))


def hash_slice(digest_column: Column, number: Column | int) -> Column:
    """Slice ``number`` (from 0) of a digest: one of ``SLICES_PER_DIGEST`` independent draws."""
    number = F.lit(number) if isinstance(number, int) else number
    return F.substring(digest_column, number * SLICE_DIGITS + 1, F.lit(SLICE_DIGITS))


def threshold(probability: float) -> str:
    """The text a draw is below with this probability."""
    return format(min(int(probability * _RANGE), _RANGE - 1), f"0{SLICE_DIGITS}x")


def split_index(columns: Sequence[Column], weights: Sequence[float], salt: str = "") -> Column:
    """Number of the split a row falls in; shares follow ``weights``."""
    draw = hash_slice(digest(columns, salt), 0)
    total = float(sum(weights))
    bounds = [sum(weights[: i + 1]) / total for i in range(len(weights) - 1)]
    return reduce(lambda n, p: n + (draw >= threshold(p)).cast("int"), bounds, F.lit(0))


def poisson_thresholds(rate: float) -> list[str]:
    """Cumulative Poisson probabilities as draw thresholds, until they reach the draw's resolution."""
    thresholds, cumulative, k = [], 0.0, 0
    while True:
        # From the logarithm, because exp(-rate) alone is zero for large rates.
        term = math.exp(k * math.log(rate) - rate - math.lgamma(k + 1)) if rate > 0 else float(k == 0)
        cumulative += term
        if (1.0 - cumulative) * _RANGE < 1 or (k > rate and term * _RANGE < 1e-3):
            return thresholds
        thresholds.append(threshold(cumulative))
        k += 1


def poisson_drawn(draw: Column, rate: float) -> Column:
    """Whether the weight is above zero: one comparison."""
    return draw >= poisson_thresholds(rate)[0]


def poisson_weight(draw: Column, rate: float) -> Column:
    """How often a row is drawn when each row is sampled with replacement at this rate."""
    steps = [(draw >= bound).cast("int") for bound in poisson_thresholds(rate)]
    return reduce(lambda a, b: a + b, steps)
