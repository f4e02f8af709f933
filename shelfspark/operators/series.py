"""Series in long form, rolling-origin folds, the seasonal-naive forecast, samples."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark import contract as C
from shelfspark.operators.scoring import BASELINE
from shelfspark.session import series_partitions


def id_columns(series: DataFrame) -> list[str]:
    """What tells series apart: the panel's keys, by which its rows already lie together, or the id alone."""
    return [*C.KEYS] if set(C.KEYS) <= set(series.columns) else ["unique_id"]


def by_id(series: DataFrame):
    return Window.partitionBy(*id_columns(series)).orderBy("ds")


def to_long(panel: DataFrame, end_date, target: str = "replenishment_signal", keyed: bool = False) -> DataFrame:
    """(unique_id, ds, y) up to and including ``end_date``. ``keyed`` also keeps the panel's keys, by which its rows already
    lie together, so that what follows needs no further shuffle."""
    return panel.where(F.col(C.DAY) <= F.lit(end_date)).select(
        *(C.KEYS if keyed else ()),
        F.concat_ws("_", *[F.col(k).cast("string") for k in C.KEYS]).alias("unique_id"),
        F.col(C.DAY).alias("ds"),
        F.col(target).cast("double").alias("y"),
    )


def fill_series(series: DataFrame) -> DataFrame:
    """Forward then backward fill inside each series; series without any value drop out.

    A leading gap takes the series' own first value and never a neighbour's, so nothing leaks
    between series and no window spans them.
    """
    before = F.last("y", ignorenulls=True).over(by_id(series).rowsBetween(Window.unboundedPreceding, 0))
    opening = F.first("y", ignorenulls=True).over(
        by_id(series).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return series.withColumn("y", F.coalesce(before, opening)).where(F.col("y").isNotNull())


def build_series(panel: DataFrame, end_date, target: str = "replenishment_signal", keyed: bool = False) -> DataFrame:
    return fill_series(to_long(panel, end_date, target, keyed))


def are_vectors(series: DataFrame) -> bool:
    """Whether a row is a whole series (``first_ds``, ``y`` of all days) and not a day of one."""
    return "first_ds" in series.columns


def target_series(source: DataFrame, end_date) -> DataFrame:
    """The series of a panel, by its keys. Vectors already are such series."""
    return source if are_vectors(source) else build_series(source, end_date, keyed=True)


def unrolled(vectors: DataFrame, since: date) -> DataFrame:
    """The days of vectors as long rows, from ``since`` on. Days before it are never made into rows."""
    keys = [c for c in vectors.columns if c not in ("first_ds", "y")]
    skipped = F.greatest(F.datediff(F.lit(since), "first_ds"), F.lit(0))
    tail = F.slice("y", skipped + 1, F.greatest(F.size("y") - skipped, F.lit(0)))
    rows = vectors.select(*keys, F.date_add("first_ds", skipped).alias("_from"), F.posexplode(tail).alias("_day", "y"))
    return rows.select(*keys, F.date_add("_from", F.col("_day")).alias("ds"), "y")


def cutoffs(
    val_end: date, horizon: int = C.GAP_HORIZON, step: int | None = None, windows: int = C.CV_WINDOWS
) -> list[date]:
    """Fold origins, oldest first; the last fold ends on ``val_end``."""
    step = step or horizon
    newest = val_end - timedelta(days=horizon)
    return [newest - timedelta(days=step * k) for k in reversed(range(windows))]


def rolling_folds(
    series: DataFrame,
    val_end: date,
    horizon: int = C.GAP_HORIZON,
    step: int | None = None,
    windows: int = C.CV_WINDOWS,
    season: int = C.SEASON_LENGTH,
) -> DataFrame:
    """Test rows of every fold with the seasonal-naive forecast:
    (unique_id, cutoff, ds, step, y, yhat).

    A row meets only the folds whose horizon covers it (one, when step = horizon); training
    rows are not multiplied by the number of folds. The forecast is the latest value of the same
    season known at the origin: a whole number of seasons back, so one of a few fixed lags. Of vectors only the days that
    these lags reach become rows.
    """
    starts = cutoffs(val_end, horizon, step, windows)
    if are_vectors(series):
        series = unrolled(series, starts[0] + timedelta(days=1 - -(-horizon // season) * season))
    origins = F.array(*[F.lit(c) for c in starts])
    covering = F.filter(
        origins, lambda c: (F.col("ds") > c) & (F.datediff(F.col("ds"), c) <= horizon)
    )
    lags = {f"_lag{k}": F.lag("y", k * season).over(by_id(series)) for k in range(1, -(-horizon // season) + 1)}
    tests = (
        series.withColumns(lags)
        .select("unique_id", "ds", "y", *lags, F.explode(covering).alias("cutoff"))
        .withColumn("step", F.datediff("ds", "cutoff"))
    )
    value = F.lit(None).cast("double")
    for k in reversed(range(1, len(lags) + 1)):
        value = F.when(F.col("step") <= k * season, F.col(f"_lag{k}")).otherwise(value)
    return tests.select("unique_id", "cutoff", "ds", "step", "y", value.alias("yhat"))


def seasonal_naive_folds(series: DataFrame, val_end: date, **options) -> DataFrame:
    return rolling_folds(series, val_end, **options).select(
        "unique_id", "cutoff", "ds", F.lit(BASELINE).alias("model"), "y", "yhat"
    )


def series_vectors(series: DataFrame) -> DataFrame:
    """(unique_id, first_ds, y[]) with one value per day.

    A vector is as long as the calendar, whatever the number of series. Rows that lie together by the panel's keys
    stay where they are; others are spread over fixed partitions. A day that a series skips or has twice is an
    error, because positions stand for days. What already are vectors stays as it is.
    """
    if are_vectors(series):
        return series.select("unique_id", "first_ds", "y")
    keys = id_columns(series)
    if keys == ["unique_id"]:
        series = series.repartition(series_partitions(series.sparkSession), "unique_id")
    ordered = F.array_sort(F.collect_list(F.struct("ds", "y")))
    days = F.datediff(F.col("obs")[F.size("obs") - 1]["ds"], F.col("obs")[0]["ds"]) + 1
    odd = F.raise_error(F.concat(F.lit("not one reading a day: "), "unique_id"))
    return (
        series.groupBy(*dict.fromkeys([*keys, "unique_id"]))
        .agg(ordered.alias("obs"))
        .select(
            "unique_id",
            F.col("obs")[0]["ds"].alias("first_ds"),
            F.when((days == F.size("obs")) & (days == F.size(F.array_distinct("obs.ds"))), F.col("obs.y"))
            .otherwise(odd.cast("array<double>"))
            .alias("y"),
        )
    )


def sample_series(series: DataFrame, size: int = 48, seed: int = 42) -> DataFrame:
    """All rows of ``size`` series drawn by hashed id: the same ones whatever the partitioning."""
    chosen = (
        series.select("unique_id")
        .distinct()
        .orderBy(F.md5(F.concat("unique_id", F.lit(f":{seed}"))), "unique_id")
        .limit(size)
    )
    return series.join(chosen, "unique_id", "left_semi")


def forecast_summary(forecasts: DataFrame, yhat: str = "yhat") -> DataFrame:
    return forecasts.agg(
        F.count(yhat).alias("forecast_records_count"),
        F.avg(yhat).alias("mean_predicted_signal"),
        F.min(yhat).alias("min_predicted_signal"),
        F.max(yhat).alias("max_predicted_signal"),
    )
