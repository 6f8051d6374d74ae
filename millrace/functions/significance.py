"""p-values: two-sided for the two-sample Kolmogorov-Smirnov distance, and of the chi-square distribution."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

LIMIT, EXACT = "limit", "exact"


def _exact_pvalue_udf():
    # Nested on purpose: a nested function travels to the executors by value, so
    # they need not have this package installed.
    @F.pandas_udf("double")
    def exact(n1: pd.Series, n2: pd.Series, gap: pd.Series) -> pd.Series:
        import numpy as np

        def one(a, b, h):
            # The merged sample is a random lattice path from (0, 0) to (a, b). Walk its
            # anti-diagonals k = i + j, keep the mass of the paths whose gap |i*b - j*a| has
            # stayed below h, and add up the mass that first reaches h. On a diagonal the
            # gap is |i*(a + b) - k*a|, so only i from low to high can be below h. Mass at the rim
            # that a double can hardly hold is let go now and then: all of it is below
            # 1e-300 a place, and the places left grow with the root of the sizes.
            total = a + b
            low, inside, outside = 0, np.ones(1), 0.0
            for k in range(1, total + 1):
                left = total - k + 1
                i = low + np.arange(len(inside))
                step = np.zeros(len(inside) + 1)
                step[:-1] = inside * (b - (k - 1 - i)) / left
                step[1:] += inside * (a - i) / left
                first = max(0, k - b, (k * a - h) // total + 1)
                last = min(a, k, -((-k * a - h) // total) - 1)
                kept = slice(max(first - low, 0), max(last - low + 1, 0))
                outside += step[: kept.start].sum() + step[kept.stop :].sum()
                inside = step[kept]
                low += kept.start
                if k % 64 == 0:
                    held = np.flatnonzero(inside > 1e-300)
                    first, last = (held[0], held[-1] + 1) if len(held) else (0, 0)
                    inside, low = inside[first:last], low + first
                if not len(inside):
                    break
            return min(outside, 1.0)

        values = [
            None if pd.isna(h) else (1.0 if h <= 0 else one(int(a), int(b), int(h)))
            for a, b, h in zip(n1, n2, gap)
        ]
        return pd.Series(values, dtype="float64")

    return exact


def large_sample_pvalue(n1: Column, n2: Column, distance: Column) -> Column:
    """Limit distribution with the finite-sample correction of Vrbik (2020).

    ``n`` is the effective size n1*n2/(n1+n2), ``x`` = D*sqrt(n), and the series is
    evaluated at x + 1/(6 sqrt(n)) + (x - 1)/(4 n). Below x = 0.2 the p-value is 1 to
    machine precision while the series converges badly.
    """
    n = F.round(n1.cast("double") * n2 / (n1 + n2))
    x = distance * F.sqrt(n)
    z = x + 1 / (6 * F.sqrt(n)) + (x - 1) / (4 * n)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * z * z),
    )
    return F.when(z < 0.2, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def ks_pvalue(n1: Column, n2: Column, gap: Column, method: str = LIMIT) -> Column:
    """p-value from the two sizes and ``gap`` = D * n1 * n2, a whole number.

    Meant for one row per feature. NULL where a sample is empty. The caller chooses between the
    limit distribution, of one cost for any size, and the exact value, whose cost grows with the
    size to the power 1.5 at most; the sizes never choose.
    """
    if method not in (LIMIT, EXACT):
        raise ValueError(f"method is {LIMIT!r} or {EXACT!r}, not {method!r}")
    distance = gap.cast("double") / (n1.cast("double") * n2.cast("double"))
    usable = (n1 > 0) & (n2 > 0)
    if method == LIMIT:
        return F.when(usable, large_sample_pvalue(n1, n2, distance))
    # The guard is also inside the arguments, because a Python function is evaluated
    # for every row whatever the branch around it says.
    exact = _exact_pvalue_udf()(
        F.when(usable, n1).otherwise(0).cast("bigint"),
        F.when(usable, n2).otherwise(0).cast("bigint"),
        F.when(usable, gap).otherwise(0).cast("bigint"),
    )
    return F.when(usable, exact)


def log_gamma(x: Column) -> Column:
    """ln(Gamma(x)) for x > 0: Stirling's series at x + 10, brought back by the recurrence."""
    far = x + 10
    series = 1 / (12 * far) - 1 / (360 * far * far * far) + 1 / (1260 * far * far * far * far * far)
    back = F.aggregate(F.sequence(F.lit(0), F.lit(9)), F.lit(0.0), lambda acc, k: acc + F.log(x + k))
    return (far - 0.5) * F.log(far) - far + 0.5 * math.log(2 * math.pi) + series - back


def _below(a: Column, x: Column) -> Column:
    """Lower regularised incomplete gamma function by its series, for x < a + 1."""
    steps = F.sequence(F.lit(1), (60 + 12 * F.sqrt(a)).cast("int"))
    start = F.struct((1 / a).alias("term"), (1 / a).alias("sum"))

    def step(acc: Column, k: Column) -> Column:
        term = acc["term"] * x / (a + k)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    return F.aggregate(steps, start, step, lambda acc: acc["sum"]) * F.exp(a * F.log(x) - x - log_gamma(a))


def _above(a: Column, x: Column) -> Column:
    """Upper regularised incomplete gamma function by its continued fraction (Lentz), for x >= a + 1."""
    steps = F.sequence(F.lit(1), (60 + 12 * F.sqrt(a)).cast("int"))
    first = 1 / (x + 1 - a)
    start = F.struct((x + 1 - a).alias("b"), F.lit(1e300).alias("c"), first.alias("d"), first.alias("h"))

    def step(acc: Column, k: Column) -> Column:
        an, b = -k * (k - a), acc["b"] + 2
        d, c = 1 / (an * acc["d"] + b), b + an / acc["c"]
        return F.struct(b.alias("b"), c.alias("c"), d.alias("d"), (acc["h"] * d * c).alias("h"))

    return F.aggregate(steps, start, step, lambda acc: acc["h"]) * F.exp(a * F.log(x) - x - log_gamma(a))


def chi_square_pvalue(freedom: Column, statistic: Column) -> Column:
    """Chance of a chi-square value of ``statistic`` or more; 1 without a degree of freedom.

    Whole-number loops inside one expression, some 12 * sqrt(freedom / 2) steps: meant for one row per feature.
    """
    # Guarded also inside, since both branches may be evaluated.
    a = F.greatest(freedom.cast("double"), F.lit(1.0)) / 2
    x = F.greatest(statistic.cast("double"), F.lit(0.0)) / 2
    small = 1 - _below(a, F.least(F.greatest(x, F.lit(1e-300)), a + 1))
    p = F.when(x < a + 1, small).otherwise(_above(a, F.greatest(x, a + 1)))
    return F.when((freedom < 1) | (x <= 0), 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), p)))
