"""Arithmetic, typing and statistics whose undefined cases give NULL instead of an error.

ANSI mode stays on: only the cases listed here are softened.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, NULL on a zero denominator."""
    return F.try_divide(numerator, denominator)


def growth(now: Column, before: Column) -> Column:
    """Relative change from ``before`` to ``now``."""
    return ratio(now, before) - F.lit(1)


def number(text: Column) -> Column:
    """Text as a finite double; anything else is NULL and left to the quality checks."""
    value = text.try_cast("double")
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def whole_number(text: Column) -> Column:
    """Text as a long; accepts ``"5.0"``."""
    return F.coalesce(text.try_cast("bigint"), number(text).try_cast("bigint"))


def day(text: Column) -> Column:
    return F.try_to_date(text)


def beta(returns: Column, market: Column) -> Column:
    """Sample covariance with the market over the market's sample variance.

    The covariance uses rows where both are known, the variance every row with a known market.
    """
    return ratio(F.covar_samp(returns, market), F.var_samp(market))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are known, NULL where it is undefined."""
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_samp(F.when(both, x)) * F.stddev_samp(F.when(both, y))
    return ratio(F.covar_samp(x, y), spread)
