"""Aggregate expressions for spread and shape."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillroll.functions.columns import col


def unbiased_skewness(c: str | Column) -> Column:
    """Adjusted Fisher-Pearson skewness; null below three values."""
    x = col(c).cast("double")
    n = F.count(x)
    factor = F.sqrt(n.cast("double") * (n - 1)) / F.when(n > 2, n - 2)
    return factor * F.skewness(x)


def unbiased_kurtosis(c: str | Column) -> Column:
    """Adjusted excess kurtosis; null below four values."""
    x = col(c).cast("double")
    n = F.count(x).cast("double")
    factor = (n - 1) / F.when(n > 3, (n - 2) * (n - 3))
    return factor * ((n + 1) * F.kurtosis(x) + 6)
