"""Outlier bounds and counts, blind windows of the signal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark import contract as C
from shelfspark.functions.lookups import with_lookup
from shelfspark.operators.grid import domains, series_keys
from shelfspark.operators.quantiles import long_values, quantile_columns


def iqr_bounds(facts: DataFrame, columns: Sequence[str] = C.OUTLIER_MEASURES) -> DataFrame:
    """(column, n, q25, q75, iqr, lower_bound, upper_bound) from exact quartiles."""
    quartiles = quantile_columns(facts, columns, {"q25": 0.25, "q75": 0.75})
    iqr = F.col("q75") - F.col("q25")
    return quartiles.select(
        "column",
        "n",
        "q25",
        "q75",
        iqr.alias("iqr"),
        (F.col("q25") - 1.5 * iqr).alias("lower_bound"),
        (F.col("q75") + 1.5 * iqr).alias("upper_bound"),
    )


def iqr_outliers(facts: DataFrame, columns: Sequence[str] = C.OUTLIER_MEASURES, bounds: DataFrame | None = None) -> DataFrame:
    """(column, outlier_count, outlier_pct) of readings strictly outside the bounds, those of ``iqr_bounds`` by default."""
    bounds = (iqr_bounds(facts, columns) if bounds is None else bounds).select("column", "lower_bound", "upper_bound")
    outside = (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))
    return (
        with_lookup(long_values(facts, columns), bounds, ["column"])
        .groupBy("column")
        .agg(
            F.count_if(outside).alias("outlier_count"),
            (F.count_if(outside) / F.count("*") * 100).alias("outlier_pct"),
        )
    )


def blind_windows(panel: DataFrame, target: str = "replenishment_signal") -> DataFrame:
    """Trailing run of missing signal per series: (store_id, category, last_known, blind_days).

    Series without any signal have been blind since the first day and get a null date.
    """
    per_series = panel.groupBy(*C.KEYS).agg(
        F.max(F.when(F.col(target).isNotNull(), F.col(C.DAY))).alias("last_known"),
        F.min(C.DAY).alias("_first"),
        F.max(C.DAY).alias("_last"),
    )
    newest = per_series.agg(F.max("_last")).scalar()
    since = F.coalesce("last_known", F.date_sub("_first", 1))
    return per_series.select(*C.KEYS, "last_known", F.datediff(newest, since).alias("blind_days"))


def blind_series(
    facts: DataFrame,
    stores: DataFrame,
    calendar: DataFrame,
    categories: DataFrame | None = None,
    target: str = "replenishment_signal",
) -> DataFrame:
    """``blind_windows`` of the dense grid, from the facts alone: the last known day of each series against the
    calendar's first and last."""
    span = calendar.agg(F.struct(F.min(C.DAY).alias("first"), F.max(C.DAY).alias("last"))).scalar()
    days = calendar.select(C.DAY).distinct()
    known = facts.where(F.col(target).isNotNull()).join(days, C.DAY, "left_semi")
    last = known.groupBy(*C.KEYS).agg(F.max(C.DAY).alias("last_known"))
    if categories is None:
        categories = domains(facts, stores, calendar)["category"]
    every = series_keys(stores.select("store_id").distinct(), categories)
    since = F.coalesce("last_known", F.date_sub(span["first"], 1))
    return every.join(last, list(C.KEYS), "left").select(
        *C.KEYS, "last_known", F.datediff(span["last"], since).alias("blind_days")
    )
