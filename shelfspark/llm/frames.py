"""Helpers on frames that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like ``wanted`` that ``df`` does not have, whatever its columns are called."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def named(column: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")
