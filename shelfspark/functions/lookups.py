"""Results of aggregations met again by the rows they came from.

The table is written once and joined by its keys, so the planner knows its size: it sends a small one to the rows and
meets a large one by a shuffle whose hot keys can be split. Nothing is gathered and no size is
assumed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.session import settle


def with_lookup(df: DataFrame, table: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every row with the columns of its entry, null without one or with a null key."""
    return df.join(settle(table, "lookup"), list(on), "left")


def lookup_list(table: DataFrame, column: str) -> Column:
    """Scalar sorted array of the distinct non-null values of a domain column, for rows that unfold all of it."""
    values = table.select(column).where(F.col(column).isNotNull()).distinct()
    return values.agg(F.array_sort(F.collect_list(column))).scalar()
