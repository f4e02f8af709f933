"""Exact quantiles of large groups without gathering a group on one task.

The built-in exact percentile keeps every distinct value of a group in the memory of one
reducer. Here equal values are counted first, so a hot value is one row; the counts are sorted by range over all
tasks and written with the number of their part. Sums per part tell which part holds a wanted rank, and
only those parts are opened. For many small groups (one per series and weekday, say) the built-in
percentile is bounded and cheaper.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.session import settle


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., column, value) rows of all non-null readings."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    return df.select(*by, F.inline(pairs)).where(F.col("value").isNotNull())


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolated quantiles: (by..., column, n, p, q), one row per probability."""
    keys = [*by, "column"]
    values = long_values(df.dropna(subset=list(by)) if by else df, columns, by)
    counted = values.groupBy(*keys, "value").agg(F.count("*").alias("copies"))
    sorted_ = settle(counted.repartitionByRange(*keys, "value").withColumn("part", F.spark_partition_id()), "sorted")

    whole = Window.partitionBy(*keys)
    sums = sorted_.groupBy(*keys, "part").agg(F.sum("copies").alias("held"))
    before = F.coalesce(F.sum("held").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = sums.select(*keys, "part", "held", before.alias("before"), F.sum("held").over(whole).alias("n"))
    # Both ranks around each place, where the part holds one of them.
    places = F.array(*[F.struct(F.lit(float(p)).alias("p"), (F.lit(float(p)) * (F.col("n") - 1)).alias("place")) for p in probs])
    ends = F.explode(F.array_distinct(F.array(F.floor("place"), F.ceil("place"))))
    wanted = (
        placed.select("*", F.inline(places))
        .select(*keys, "part", "before", "held", "n", "p", "place", ends.alias("rank"))
        .where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("held")))
    )
    wanted = settle(wanted.drop("held"), "wanted")
    opened = sorted_.join(wanted.select(*keys, "part", "before").distinct(), [*keys, "part"])
    upto = Window.partitionBy(*keys, "part").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    reached = opened.select(*keys, "part", "value", "copies", (F.col("before") + F.sum("copies").over(upto)).alias("seen"))
    hits = reached.join(wanted.drop("before"), [*keys, "part"]).where(
        (F.col("rank") < F.col("seen")) & (F.col("rank") >= F.col("seen") - F.col("copies"))
    )
    left = F.min("value")
    return hits.groupBy(*keys, "n", "p", "place").agg(
        (left + (F.max("value") - left) * (F.col("place") - F.floor("place"))).alias("q")
    ).drop("place")


def quantile_columns(
    df: DataFrame, columns: Sequence[str], named: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """One row per (by..., column) with a named column for each probability."""
    long = exact_quantiles(df, columns, list(named.values()), by)
    return long.groupBy(*by, "column").agg(
        F.max("n").alias("n"),
        *[F.max(F.when(F.col("p") == p, F.col("q"))).alias(name) for name, p in named.items()],
    )


def median_columns(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One row per group with ``<column>_median`` columns."""
    long = exact_quantiles(df, columns, [0.5], by)
    return long.groupBy(*by).agg(
        *[F.max(F.when(F.col("column") == c, F.col("q"))).alias(f"{c}_median") for c in columns]
    )
