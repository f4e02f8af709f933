"""Target encodings learned on the training split and ordinal encodings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark import contract as C
from shelfspark.session import settle

ENCODED = ("category", "store_format")


# Names the row that holds the global mean.
OVERALL = "overall"


def fit_target_means(
    train: DataFrame, target: str = "replenishment_signal", columns: Sequence[str] = ENCODED
) -> DataFrame:
    """(column, key, mean_target) for every level, plus the global mean under ``overall``.

    Grouping sets give all of them in one pass over the training rows.
    """
    present = [c for c in columns if c in train.columns]
    sets = [[F.col(c)] for c in present] + [[]]
    means = train.groupingSets(sets, *present).agg(
        F.grouping_id().alias("level"), F.avg(F.col(target).cast("double")).alias("mean_target")
    )
    everything = (1 << len(present)) - 1
    column = key = F.lit(OVERALL)
    for i, c in enumerate(present):
        mine = F.col("level") == (everything & ~(1 << (len(present) - 1 - i)))
        column, key = F.when(mine, F.lit(c)).otherwise(column), F.when(mine, F.col(c).cast("string")).otherwise(key)
    return means.select(column.alias("column"), key.alias("key"), "mean_target").where(F.col("key").isNotNull())


def apply_target_means(df: DataFrame, means: DataFrame, columns: Sequence[str] = ENCODED) -> DataFrame:
    """``<column>_target_enc``; keys unseen in training get the global training mean.

    The means are written once, so that the planner sees whether they are few enough to send to the rows.
    """
    means = settle(means, "means")
    overall = means.where(F.col("column") == OVERALL).agg(F.max("mean_target")).scalar()
    for c in columns:
        if c in df.columns:
            own = means.where(F.col("column") == c).select(
                F.col("key").alias("_key"), F.col("mean_target").alias(f"{c}_target_enc")
            )
            df = df.join(own, F.col(c).cast("string") == F.col("_key"), "left").drop("_key")
            df = df.withColumn(f"{c}_target_enc", F.coalesce(f"{c}_target_enc", overall))
    return df


def ordinal(column: str, order: dict[str, int], default: int = 0) -> Column:
    """Rank of a value in a fixed order; unknown and null take the default."""
    expr = F.lit(None).cast("int")
    for value, rank in order.items():
        expr = F.when(F.col(column) == value, F.lit(rank)).otherwise(expr)
    return F.coalesce(expr, F.lit(default))


def with_socioeconomic_rank(df: DataFrame) -> DataFrame:
    if "socioeconomic_level" not in df.columns:
        return df
    return df.withColumn(
        "socioeconomic_level_ord", ordinal("socioeconomic_level", C.SOCIOECONOMIC_ORDER)
    )


def encode(df: DataFrame, means: DataFrame) -> DataFrame:
    return df.transform(apply_target_means, means).transform(with_socioeconomic_rank)
