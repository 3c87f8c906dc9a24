"""Student's t distribution with whole degrees of freedom.

The central probability is a finite sum (Abramowitz and Stegun, 26.7.3 and 26.7.4). With t = sqrt(v) tan(a),
the sum runs over powers of cos(a)^2, and the step from one coefficient to the next is
(2k - 1 + q) / (2k + q), where q is 1 for odd v and 0 for even v.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

TAIL_TERMS = 60  # terms at least halve, so the rest is below the last bit


def two_sided_p(t: Column, dof: Column) -> Column:
    """P(|T| > |t|); null where t is null."""
    odd = dof % 2
    terms = F.floor(dof / 2).cast("int")
    cos2 = dof / (dof + t * t)
    angle = F.atan(F.abs(t) / F.sqrt(dof))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def step(acc: Column, k: Column) -> Column:
        term = acc["term"] * cos2 * (2 * k - 1 + odd) / (2 * k + odd)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    ks = F.when(terms > 1, F.sequence(F.lit(1), terms - 1)).otherwise(F.array().cast("array<int>"))
    series = F.when(terms > 0, F.aggregate(ks, start, step)["total"]).otherwise(F.lit(0.0))
    even_form = F.sin(angle) * series
    odd_form = (angle + F.sin(angle) * F.cos(angle) * series) * (2 / math.pi)
    central = F.greatest(1 - F.when(odd == 1, odd_form).otherwise(even_form), t * 0)
    return F.when(t * t > dof, _tail(cos2, dof)).otherwise(central)


def _tail(x: Column, dof: Column) -> Column:
    """The same for |t| > sqrt(v), without the loss of digits of one minus a number near one.

    The regularized incomplete beta function of x = v / (v + t^2) < 1/2 at a = v/2, b = 1/2 as its power series, whose
    terms at least halve. 1/B(a, 1/2) grows from B(1, 1/2) = 2 or B(1/2, 1/2) = pi by the factor (a + 1/2) / a.
    """
    a = dof / 2
    steps = F.floor((dof - 1) / 2).cast("int")  # from a = 1 or 1/2 up to v/2
    first = F.when(dof % 2 == 1, F.lit(1 / math.pi)).otherwise(F.lit(0.5))
    start = F.when(dof % 2 == 1, F.lit(0.5)).otherwise(F.lit(1.0))
    ups = F.when(steps > 0, F.sequence(F.lit(0), steps - 1)).otherwise(F.array().cast("array<int>"))
    inverse_beta = F.aggregate(ups, first, lambda value, k: value * (start + k + 0.5) / (start + k))

    def step(acc: Column, n: Column) -> Column:
        term = acc["term"] * x * (n - 0.5 + a) / (n + a)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    one = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(TAIL_TERMS)), one, step)["total"]
    return F.pow(x, a) * F.sqrt(1 - x) * inverse_beta / a * series


def _central_probability(t: float, dof: int) -> float:
    odd, angle = dof % 2, math.atan(t / math.sqrt(dof))
    cos2, term, series = math.cos(angle) ** 2, 1.0, 0.0
    for k in range(dof // 2):
        if k:
            term *= cos2 * (2 * k - 1 + odd) / (2 * k + odd)
        series += term
    if odd:
        return (angle + math.sin(angle) * math.cos(angle) * series) * 2 / math.pi
    return math.sin(angle) * series


def t_critical(confidence: float, dof: int) -> float:
    """The t whose central probability is ``confidence``: one number, found by halving an interval."""
    low, high = 0.0, 1.0
    while _central_probability(high, dof) < confidence:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        if _central_probability(middle, dof) < confidence:
            low = middle
        else:
            high = middle
    return (low + high) / 2
