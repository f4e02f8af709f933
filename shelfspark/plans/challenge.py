"""The challenge run: fast models on every series, a slow contrast on a sample."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.operators import scoring, series, smoothing
from shelfspark.session import settle


def fleet_scores(source: DataFrame, val_end: date, models: tuple[str, ...] = smoothing.MODELS) -> DataFrame:
    """WAPE and losses of every model over all series, null WAPE without actuals."""
    s = series.target_series(source, val_end)
    folds = smoothing.model_folds(s, val_end, models).unionByName(series.seasonal_naive_folds(s, val_end))
    return scoring.score(folds, on_zero=None)


def sample_scores(source: DataFrame, val_end: date, challenger: str = smoothing.THETA, size: int = 48) -> DataFrame:
    """The baseline and one challenger on the same deterministic sample of series."""
    s = series.sample_series(series.target_series(source, val_end), size)
    folds = smoothing.model_folds(s, val_end, (challenger,)).unionByName(series.seasonal_naive_folds(s, val_end))
    return scoring.score(folds, on_zero=None)


def challenge(source: DataFrame, val_end: date, size: int = 48) -> DataFrame:
    """(stage, model, wape, place, baseline_wape, beats_baseline) for the fleet and the sample. Vectors are written once
    for all of them."""
    if series.are_vectors(source):
        source = settle(source, "vectors")
    stages = fleet_scores(source, val_end).withColumn("stage", F.lit("fleet")).unionByName(
        sample_scores(source, val_end, size=size).withColumn("stage", F.lit("sample"))
    )
    return scoring.ranking(stages, by=["stage"])
