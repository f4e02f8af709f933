"""The training run: panel, features, boosted models, rolling evaluation, gate, blind forecast."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark import contract as C
from shelfspark.functions.history import Wanted
from shelfspark.operators import boosting, encoders, features, scoring, series, smoothing
from shelfspark.operators.grid import master_panel, repaired_grid, repaired_rows, unfold_vectors
from shelfspark.session import settle
from shelfspark.sources.documents import flatten

LAG_BASELINE = "SeasonalNaive"


@dataclass(frozen=True)
class Inputs:
    facts: DataFrame
    stores: DataFrame
    calendar: DataFrame
    splits: C.Splits
    categories: DataFrame | None = None


def panel(inputs: Inputs, wanted: Wanted | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    return master_panel(
        inputs.facts, inputs.stores, inputs.calendar, inputs.splits.train_end, inputs.categories, wanted, keep
    )


def panel_vectors(inputs: Inputs, end: date) -> DataFrame:
    """The panel's target series up to ``end`` as vectors, which all that takes a panel's series takes as well."""
    rows = repaired_rows(inputs.facts, inputs.stores, inputs.calendar, inputs.splits.train_end, inputs.categories)
    return unfold_vectors(rows, inputs.calendar, end)


def feature_panel(inputs: Inputs, keep: Sequence[str] | None = None) -> DataFrame:
    """All features and the split label, encodings not yet fitted. Windows run over the calendar's own days. ``keep`` names
    the other columns of facts and stores that are needed, all by default."""
    wanted = features.window_features(inputs.facts.columns)
    grid = repaired_grid(
        inputs.facts, inputs.stores, inputs.calendar, inputs.splits.train_end, inputs.categories, wanted, keep
    )
    return features.engineer_features(grid, inputs.calendar).transform(features.with_split, inputs.splits)


def target_means(inputs: Inputs) -> DataFrame:
    """Target encodings of the training split. Empty cells have no target, so the facts of the grid say it all."""
    train = inputs.facts.where(features.split_column(inputs.splits) == "TRAIN").where(F.col("category").isNotNull())
    dated = train.join(inputs.calendar.select(C.DAY).distinct(), C.DAY, "left_semi")
    return encoders.fit_target_means(dated.join(inputs.stores.select("store_id", "store_format"), "store_id"))


def training_matrix(inputs: Inputs) -> DataFrame:
    """Complete TRAIN and VAL rows with keys, split, target and the gap-safe features."""
    featured = feature_panel(inputs)
    encoded = encoders.encode(featured, target_means(inputs))
    columns = features.gap_safe_columns(encoded.columns)
    return features.complete_cases(
        encoded.where(F.col("split").isin("TRAIN", "VAL")), columns
    ).select(*C.KEYS, C.DAY, "split", "replenishment_signal", *columns)


def matrix_features(matrix: DataFrame) -> list[str]:
    return [c for c in matrix.columns if c not in (*C.KEYS, C.DAY, "split", "replenishment_signal")]


def lag_baseline(matrix: DataFrame) -> DataFrame:
    """(model, y, yhat) of the value one week ago on complete VAL rows."""
    return matrix.where(F.col("split") == "VAL").select(
        F.lit(LAG_BASELINE).alias("model"),
        F.col("replenishment_signal").alias("y"),
        F.col("replenishment_signal_lag_7d").alias("yhat"),
    )


def tabular_forecasts(matrix: DataFrame, models: dict[str, boosting.DemandRegressor]) -> DataFrame:
    """Fit each boosted model on TRAIN and predict VAL, next to the lag baseline.

    The matrix is written once, because every boosting round passes over it.
    """
    matrix = settle(matrix)
    names = matrix_features(matrix)
    train, val = (matrix.where(F.col("split") == s) for s in ("TRAIN", "VAL"))
    out = lag_baseline(matrix)
    for name, model in models.items():
        model.fit(train, names, val)
        predicted = model.predict(val).select(
            F.lit(name).alias("model"),
            F.col("replenishment_signal").alias("y"),
            F.col(boosting.PREDICTION).alias("yhat"),
        )
        out = out.unionByName(predicted)
    return out


def rolling_forecasts(
    source: DataFrame, splits: C.Splits, models: tuple[str, ...] = (smoothing.ETS,), **options
) -> DataFrame:
    """Folds of the smoothing models and of the seasonal-naive baseline. Vectors are written once for both."""
    s = series.target_series(source, splits.val_end)
    if series.are_vectors(s):
        s = settle(s, "vectors")
    return smoothing.model_folds(s, splits.val_end, models, **options).unionByName(
        series.seasonal_naive_folds(s, splits.val_end, **options)
    )


def blind_forecast(source: DataFrame, splits: C.Splits) -> DataFrame:
    """Forecast of the holdout days from everything known by the end of VAL."""
    s = series.target_series(source, splits.val_end)
    return smoothing.forecast_ahead(s, splits.val_end, splits.holdout_days)


def split_counts(source: DataFrame, splits: C.Splits) -> DataFrame:
    return features.with_split(source, splits).where(F.col("split").isNotNull()).groupBy("split").agg(
        F.count("*").alias("rows")
    )


def results(
    source: DataFrame, splits: C.Splits, matrix: DataFrame | None = None, models: dict | None = None
) -> DataFrame:
    """The run's result rows: counts, scores, gate, blind-forecast summary; with ``matrix`` and
    ``models`` also the tabular contrast."""
    scores = scoring.score(rolling_forecasts(source, splits))
    parts = [
        flatten(split_counts(source, splits), "dataset_summary", "rows", ["split"]),
        flatten(scores, "production_forecaster", "scores", ["model"]),
        flatten(scoring.gate(scores), "production_forecaster", "gate"),
        flatten(series.forecast_summary(blind_forecast(source, splits)), "holdout_forecast_summary", "holdout"),
    ]
    if matrix is not None and models:
        tabular = scoring.score(tabular_forecasts(matrix, models))
        parts.append(flatten(tabular, "model_performance", "tabular", ["model"]))
        parts.append(flatten(scoring.savings(tabular), "model_performance", "tabular"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
