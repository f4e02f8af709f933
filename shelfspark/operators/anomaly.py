"""Isolation forest over the fact table and classification of what it flags."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark import contract as C
from shelfspark.functions import forest as kernels
from shelfspark.operators.grid import with_calendar
from shelfspark.operators.quantiles import exact_quantiles
from shelfspark.session import settle

cloudpickle.register_pickle_by_value(kernels)

SAMPLE_SIZE = 256
TREES = 100
NODES = "tree int, node int, feature int, threshold double, left int, right int, reach double"


@dataclass
class Forest:
    """A fitted forest: a few hundred nodes per tree, whatever the size of the data."""

    features: list[str]
    trees: list
    sample_size: int


def _draw(facts: DataFrame, seed: int, size: int) -> DataFrame:
    """The ``size`` rows with the smallest hash of key and seed.

    A hash threshold leaves about four times that many before they are ordered, so no task sees
    more than that, however many rows there are.
    """
    rows = facts.agg(F.count("*")).scalar()
    unit = F.pmod(F.xxhash64(*C.KEYS, C.DAY, F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    return (
        facts.withColumn("draw", unit)
        .where(F.col("draw") < F.lit(4.0 * size) / rows)
        .orderBy("draw")
        .limit(size)
    )


def fit_forest(
    facts: DataFrame,
    features: Sequence[str] = C.FOREST_FEATURES,
    trees: int = TREES,
    sample_size: int = SAMPLE_SIZE,
    seed: int = 42,
) -> Forest:
    """Grow every tree on its own hashed sample of the complete rows, one group per tree."""
    columns = list(features)
    complete = facts.dropna(subset=columns)
    pool = _draw(complete, seed, sample_size * trees).select(
        *C.KEYS, C.DAY, *[F.col(c).cast("double").alias(c) for c in columns]
    )
    per_tree = pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn(
        "draw", F.xxhash64(*C.KEYS, C.DAY, F.col("tree"), F.lit(seed))
    )
    chosen = per_tree.withColumn(
        "_place", F.row_number().over(Window.partitionBy("tree").orderBy("draw"))
    ).where(F.col("_place") <= sample_size)

    def grow(sample: pd.DataFrame) -> pd.DataFrame:
        return kernels.grow_group(sample, columns, seed)

    sampled = chosen.select("tree", "draw", *columns)
    nodes = sampled.groupBy("tree").applyInPandas(grow, NODES).toPandas()
    used = sample_size if len(nodes) == 0 else min(sample_size, pool.count())
    return Forest(columns, kernels.pack(nodes), used)


def score_rows(facts: DataFrame, forest: Forest) -> DataFrame:
    """Complete rows with ``normality``, the negated anomaly score."""
    trees, size = forest.trees, forest.sample_size
    shipped = facts.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("double")
    def normality(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(float) for c in columns])
        return pd.Series(kernels.normality(x, shipped.value, size))

    complete = facts.dropna(subset=forest.features)
    return complete.withColumn("normality", normality(*[F.col(c).cast("double") for c in forest.features]))


def flag_anomalies(scored: DataFrame, contamination: float = C.FOREST_CONTAMINATION) -> DataFrame:
    """Rows whose normality lies strictly below the contamination quantile."""
    cut = exact_quantiles(scored, ["normality"], [contamination]).agg(F.max("q")).scalar()
    return scored.where(F.col("normality") < cut)


def classify_anomalies(anomalies: DataFrame, calendar: DataFrame) -> DataFrame:
    """``commercial`` on event days; ``pos_error`` for zero sales, lost readings or no event.

    The two overlap, so they are two columns and not one label.
    """

    def on(flag: str):
        return F.coalesce(F.col(flag), F.lit(False))

    event = on("is_holiday") | on("is_buen_fin") | on("is_navidad_season") | on("is_payday")
    lost = F.col("cash_transactions").isNull() & F.col("units_sold").isNull()
    dated = with_calendar(anomalies, calendar).withColumn("commercial", event)
    return dated.withColumn("pos_error", (F.col("amount_total") == 0) | lost | ~F.col("commercial"))


def summarize_anomalies(classified: DataFrame) -> DataFrame:
    return classified.agg(
        F.count("*").alias("anomalies"),
        F.count_if("commercial").alias("commercial_events"),
        F.count_if("pos_error").alias("probable_pos_errors"),
    )


def find_anomalies(facts: DataFrame, calendar: DataFrame, seed: int = 42) -> DataFrame:
    """Fit, score, cut and classify. Scores are settled once because three jobs read them."""
    forest = fit_forest(facts, seed=seed)
    scored = settle(score_rows(facts, forest))
    return classify_anomalies(flag_anomalies(scored), calendar)
