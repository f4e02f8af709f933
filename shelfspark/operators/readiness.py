"""Category domains, collinear measures and grid sparsity."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark import contract as C
from shelfspark.operators.columns import null_counts, value_counts


def domain_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) for every distinct non-null value."""
    return value_counts(df, columns).where(F.col("value").isNotNull()).select("column", "value")


def domain_sizes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, cardinality) without null."""
    return domain_values(df, columns).groupBy("column").agg(F.count("*").alias("cardinality"))


def repair_need(facts: DataFrame, columns: Sequence[str] = ("amount_cash", "units_sold", "replenishment_signal")) -> DataFrame:
    """Null share of the columns that have a repair strategy."""
    return null_counts(facts.select(*columns)).select("column", "null_percentage")


def _pair(a: str, b: str, value: Column) -> Column:
    return F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), value.alias("correlation"))


def correlation_pairs(facts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(var1, var2, correlation) for every pair i < j, all in one aggregation.

    Rows of (pair, x, y) share one aggregate. One for each pair makes a method that the JVM no longer compiles.
    """
    pairs = [*combinations(columns, 2)]
    values = (F.struct(F.lit(i).alias("nth"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y")) for i, (a, b) in enumerate(pairs))
    found = facts.select(F.inline(F.array(*values))).groupBy("nth").agg(F.corr("x", "y").alias("correlation"))
    named = facts.sparkSession.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "nth int, var1 string, var2 string")
    # A pair without any row has no correlation.
    return named.join(found, "nth", "left").select("var1", "var2", "correlation")


def collinear_pairs(
    facts: DataFrame, columns: Sequence[str] = C.COLLINEAR_MEASURES, threshold: float = 0.85
) -> DataFrame:
    return correlation_pairs(facts, columns).where(F.abs("correlation") > threshold)


def correlation_matrix(facts: DataFrame, columns: Sequence[str] = C.MEASURES) -> DataFrame:
    """The full matrix in long form; one triangle is computed and mirrored."""
    upper = correlation_pairs(facts, columns)
    diagonal = facts.agg(
        F.array(*[_pair(c, c, F.corr(c, c)) for c in columns]).alias("pairs")
    ).select(F.inline("pairs"))
    mirrored = upper.select(F.col("var2").alias("var1"), F.col("var1").alias("var2"), "correlation")
    return upper.unionByName(mirrored).unionByName(diagonal)


def grid_sparsity(facts: DataFrame) -> DataFrame:
    """Rows against the full product of observed stores, categories and days."""
    sizes = facts.agg(
        F.countDistinct("store_id").alias("unique_stores"),
        F.countDistinct("category").alias("unique_categories"),
        F.countDistinct("date").alias("total_days"),
        F.count("*").alias("actual_rows"),
    )
    full = F.col("unique_stores") * F.col("unique_categories") * F.col("total_days")
    return sizes.withColumn("theoretical_rows", full).select(
        "*",
        (F.col("theoretical_rows") - F.col("actual_rows")).alias("missing_rows"),
        ((1 - F.try_divide("actual_rows", "theoretical_rows")) * 100).alias("sparsity_pct"),
    )
