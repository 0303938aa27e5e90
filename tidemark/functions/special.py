"""Upper tail of the chi-squared distribution as a column expression.

With a = dof / 2 and x = statistic / 2 the lower tail is the series
``exp(a ln x - x - lnGamma(a + 1)) * (1 + x / (a + 1) + x^2 / ((a + 1)(a + 2)) + …)``.
All its terms are positive. Where Chernoff's bound puts the upper tail below
1e-18, it is 0 without summing; elsewhere x is near enough to a that the number
of terms below has a bound, and the terms left out sum to less than 1e-18.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def log_gamma_next(dof: Column) -> Column:
    """``lnGamma(dof / 2 + 1)`` of a whole ``dof`` of at least 1: a sum of logarithms."""
    odd = dof % 2
    start = F.when(odd == 1, F.lit(math.log(math.sqrt(math.pi)))).otherwise(F.lit(0.0))
    steps = F.sequence(F.lit(1).cast("bigint"), ((dof + odd) / 2).cast("bigint"))
    return F.aggregate(steps, start, lambda total, i: total + F.log(i - odd / 2))


def chi2_tail(statistic: str | Column, dof: str | Column) -> Column:
    """P(X >= statistic); 1 where there is no degree of freedom.

    The result has the absolute resolution of ``1 - cdf``: smaller tails are 0
    and therefore tie.
    """
    statistic = F.col(statistic) if isinstance(statistic, str) else statistic
    dof = (F.col(dof) if isinstance(dof, str) else dof).cast("bigint")
    x, a = statistic / 2, dof / 2
    bound = a - x + a * F.log(x / a)
    first = F.exp(a * F.log(x) - x - log_gamma_next(dof))
    # From twice x on, each term is at most half of the one before.
    many = F.sequence(F.lit(1).cast("bigint"), (2 * x + 64).cast("bigint"))
    empty = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(state: Column, k: Column) -> Column:
        term = state["term"] * x / (a + k)
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    series = F.aggregate(many, empty, add, lambda state: state["total"])
    return (
        F.when((dof <= 0) | (statistic <= 0), F.lit(1.0))
        .when((x > a) & (bound < math.log(1e-18)), F.lit(0.0))
        .otherwise(F.greatest(1 - first * series, F.lit(0.0)))
    )
