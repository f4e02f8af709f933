"""Quantiles from states that are kept per part of the data and merged.

A state is the number of readings of a part (a day, say) with POINTS + 1 of its values at ranks in equal steps. Between two of
these values lie 1 / POINTS of the part's readings, and their ranks are off by 1 / ACCURACY at most. Merging weighs every value
with the part's readings, so errors of parts add up in proportion to their size and the bound stays what it was,
however many parts there are. States are small rows of a table: new days are appended, old ones are never read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark import contract as C
from shelfspark.operators.quantiles import long_values

POINTS, ACCURACY = 100, 1000


def rank_bound(points: int = POINTS, accuracy: int = ACCURACY) -> float:
    """No quantile's rank is further from the wanted one, as a share of all readings."""
    return 1 / points + 1 / accuracy


def part_states(
    df: DataFrame, columns: Sequence[str], parts: Sequence[str] = (C.DAY,), points: int = POINTS, accuracy: int = ACCURACY
) -> DataFrame:
    """(parts..., column, n, points): one state for each part and column with readings, in one aggregation."""
    ranks = [i / points for i in range(points + 1)]
    states = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("n"),
            F.percentile_approx(F.col(c).cast("double"), ranks, accuracy).alias("points"),
        )
        for c in columns
    ]
    found = df.groupBy(*parts).agg(F.array(*states).alias("states")).select(*parts, F.inline("states"))
    return found.where(F.col("n") > 0)


def merged_quantiles(states: DataFrame, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, n, p, q) from the states of all parts. A group holds POINTS + 1 values of each of its parts."""
    values = states.select(*by, "column", "n", F.posexplode("points").alias("i", "value"))
    own = F.percentile("value", F.array(*map(F.lit, probs)), F.col("n"))
    merged = values.groupBy(*by, "column").agg(F.sum(F.when(F.col("i") == 0, F.col("n"))).alias("n"), own.alias("q"))
    pairs = F.arrays_zip(F.array(*map(F.lit, probs)).alias("p"), F.col("q"))
    return merged.select(*by, "column", "n", F.inline(pairs).alias("p", "q"))


def rank_errors(df: DataFrame, found: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``found`` with ``rank_error``: how far ``p`` is from the ranks that ``q`` has among all readings, by an exact count."""
    columns = [r["column"] for r in found.select("column").distinct().collect()]  # names of measures
    keys = [*by, "column"]
    counted = long_values(df, columns, by).join(found, keys).groupBy(*keys, "n", "p", "q").agg(
        F.count_if(F.col("value") < F.col("q")).alias("below"), F.count_if(F.col("value") <= F.col("q")).alias("upto")
    )
    low, high = F.col("below") / F.col("n"), F.col("upto") / F.col("n")
    return counted.withColumn("rank_error", F.greatest(F.lit(0.0), low - F.col("p"), F.col("p") - high)).drop("below", "upto")
