"""Moment statistics in the sample (bias-corrected) forms pandas reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def skew_sample(c) -> Column:
    """Adjusted Fisher-Pearson skewness G1 (null below 3 values)."""
    n = F.count(_c(c)).cast("double")
    g1 = F.skewness(_c(c))
    return F.when(n >= 3, F.sqrt(n * (n - 1)) / (n - 2) * g1)


def kurt_sample(c) -> Column:
    """Bias-corrected excess kurtosis G2 (null below 4 values)."""
    n = F.count(_c(c)).cast("double")
    g2 = F.kurtosis(_c(c))
    return F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))
