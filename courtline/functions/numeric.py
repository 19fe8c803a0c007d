"""Exact rounding of averages.

The model rounds averages computed in exact decimal arithmetic (half away from
zero).  Averaging doubles first makes the result depend on summation order,
which differs between tasks.  Here a value with at most ``scale`` decimals is
summed as an integer (exact in any order) and the quotient is rounded with
integer arithmetic.  Ratios, which have no last decimal, are averaged from their
numerators and denominators.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def scaled_sum(c: Column, scale: int = 0) -> Column:
    """Exact sum of values that have at most ``scale`` decimals, as a long of units 10^-scale."""
    if scale == 0:
        return F.sum(c.cast("long"))
    return F.sum(F.round(c * (10 ** scale)).cast("long"))


def round_ratio(num: Column, den: Column, decimals: int, scale: int = 0) -> Column:
    """round(num / (den * 10^scale), decimals), half away from zero, NULL when den is 0/NULL."""
    m = 10 ** scale
    p = 10 ** decimals
    a = F.abs(num) * (2 * p) + den * m
    b = den * (2 * m)
    q = (a - a % b) / b
    sign = F.when(num < 0, F.lit(-1)).otherwise(F.lit(1))
    return F.when(den > 0, (sign * q.cast("long")) / p)


def avg_parts(name: str, c: Column, scale: int = 0) -> list[Column]:
    """Aggregate columns (exact sum, count) for :func:`avg_rounded`."""
    return [scaled_sum(c, scale).alias(f"_s_{name}"), F.count(c).alias(f"_n_{name}")]


def avg_rounded(name: str, decimals: int, scale: int = 0) -> Column:
    """The rounded average from the columns made by :func:`avg_parts`."""
    return round_ratio(F.col(f"_s_{name}"), F.col(f"_n_{name}"), decimals, scale).alias(name)


#: A ratio's decimals that are summed, as whole numbers of nine digits each.
RATIO_LIMBS = 3
_LIMB = 10 ** 9


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def ratio_parts(name: str, num: Column, den: Column) -> list[Column]:
    """Aggregate columns of the exact average of ``num / den`` (whole numbers, 0 < den < 2**31) for :func:`avg_ratio_rounded`.

    A ratio is its floor and 27 decimals, cut off, in long division; each is
    summed on its own as a long, so the sums are the same in any order and are
    merged on the map side like any other.  ``den`` is never NULL; a NULL ``num`` is left out.
    """
    n, d = num.cast("long"), den.cast("long")
    rest = F.pmod(n, d)
    out = [F.count(n).alias(f"_n_{name}"), F.sum(_div(n - rest, d)).alias(f"_w_{name}")]
    for k in range(RATIO_LIMBS):
        out.append(F.sum(_div(rest * _LIMB, d)).alias(f"_f{k}_{name}"))
        rest = (rest * _LIMB) % d
    return out


def avg_ratio_rounded(name: str, decimals: int) -> Column:
    """The average from :func:`ratio_parts`, rounded half away from zero; NULL without rows.

    With sum Q of the parts (units of 10^-27) and n rows, the sum of the ratios
    lies in [Q, Q + n).  It is equal to a rounding border or differs from it by
    1 / (2 * 10^decimals * L) at least, L the least common multiple of the denominators.  So
    it reaches a border just when Q + n - 1 does (below zero: when -Q does),
    as long as L * n <= 5 * 10^(26 - decimals): the result is that of exact
    arithmetic, ties included.  Beyond, it can differ only within n * 10^-27 of a border.
    """
    whole = lambda c: f"cast({c} as decimal(38,0))"
    n = whole(f"_n_{name}")
    q = whole(f"_w_{name}")
    for k in range(RATIO_LIMBS):
        q = f"({q} * {whole(_LIMB)} + {whole(f'_f{k}_{name}')})"
    step = f"({n} * {whole('1' + '0' * (9 * RATIO_LIMBS - decimals))})"
    size = f"if({q} < 0, -{q}, {q} + {n} - 1)"
    return F.expr(f"case when _n_{name} > 0 then if({q} < 0, -1, 1) * ((2 * {size} + {step}) div (2 * {step})) / {10 ** decimals}D end").alias(name)
