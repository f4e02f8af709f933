"""Bias-corrected shape statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_skewness(column: Column) -> Column:
    """Adjusted Fisher-Pearson skewness; null below three readings, 0 without spread."""
    n = F.count(column).cast("double")
    spread = F.coalesce(F.skewness(column), F.lit(0.0))
    return F.when(n >= 3, F.when(F.isnan(spread), 0.0).otherwise(spread * F.sqrt(n * (n - 1)) / (n - 2)))


def sample_kurtosis(column: Column) -> Column:
    """Bias-corrected excess kurtosis; null below four readings, 0 without spread."""
    n = F.count(column).cast("double")
    g2 = F.kurtosis(column)
    corrected = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)
    flat = g2.isNull() | F.isnan(g2)
    return F.when(n >= 4, F.when(flat, 0.0).otherwise(corrected))
