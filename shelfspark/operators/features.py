"""Leak-free features: lags, rolling statistics, ratios, calendar phases, splits."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark import contract as C
from shelfspark.functions import history

# The executors need NumPy, not this package.
cloudpickle.register_pickle_by_value(history)


def by_series():
    """One specification for every lag and frame, so they share one sort of the series."""
    return Window.partitionBy(*C.KEYS).orderBy(C.DAY)


def _present(panel: DataFrame, targets: Iterable[str]) -> list[str]:
    return [t for t in targets if t in panel.columns]


def lag_columns(targets: Sequence[str], lags: Sequence[int]) -> dict[str, Column]:
    return {f"{t}_lag_{n}d": F.lag(t, n).over(by_series()) for t in targets for n in lags}


def rolling_features(targets: Sequence[str] = C.ROLL_TARGETS, windows: Sequence[int] = C.ROLL_DAYS) -> history.Wanted:
    return history.Wanted(rolling={f"{t}_roll_{kind}_{w}d": (t, kind, w) for t in targets for w in windows for kind in ("mean", "std")})


#: Cash share of the previous 30 days, clipped to 0..1; null without history.
CASH_SHARE = ("cash_ratio_roll_30d", "amount_cash", "amount_total", 30)


def _with_history(panel: DataFrame, wanted: history.Wanted) -> DataFrame:
    """Lags and rolling columns of whole series in NumPy. Rows that already lie together by series stay where they are.

    A sliding frame of the JVM goes over all its rows again for each row and column; the kernel adds shifted vectors instead.
    """
    if not wanted.names:
        return panel
    kept = [f for f in panel.schema.fields if f.name not in wanted.names]
    schema, day = T.StructType([*kept, *history_fields(panel.schema, wanted)]), C.DAY

    def run(rows: pa.Table) -> pa.Table:
        return history.with_history(history.in_order(rows, day), wanted)

    return panel.select(*(f.name for f in kept)).groupBy(*C.KEYS).applyInArrow(run, schema)


def history_fields(schema: T.StructType, wanted: history.Wanted) -> list[T.StructField]:
    kinds = {name: schema[t].dataType for name, (t, _) in wanted.lags.items()}
    return [T.StructField(c, kinds.get(c, T.DoubleType())) for c in wanted.names]


def window_features(columns: Iterable[str]) -> history.Wanted:
    """Lags, rolling frames and the payment ratio that a panel with these columns gets."""
    have = set(columns)
    return history.Wanted(
        {f"{t}_lag_{n}d": (t, n) for t in C.LAG_TARGETS if t in have for n in C.LAG_DAYS},
        rolling_features([t for t in C.ROLL_TARGETS if t in have]).rolling,
        CASH_SHARE if {"amount_cash", "amount_total"} <= have else None,
    )


def add_lags(
    panel: DataFrame, targets: Sequence[str] = C.LAG_TARGETS, lags: Sequence[int] = C.LAG_DAYS
) -> DataFrame:
    """Values ``n`` rows earlier in the series. A row is a day because the panel is dense."""
    return panel.withColumns(lag_columns(_present(panel, targets), lags))


def add_rolling(
    panel: DataFrame, targets: Sequence[str] = C.ROLL_TARGETS, windows: Sequence[int] = C.ROLL_DAYS
) -> DataFrame:
    """Mean and sample deviation of the previous days, today excluded, unless the grid made them while it unfolded."""
    wanted = rolling_features(_present(panel, targets), windows)
    return panel if set(wanted.names) <= set(panel.columns) else _with_history(panel, wanted)


def add_store_ratios(panel: DataFrame) -> DataFrame:
    """Yesterday's sales per square metre and per checkout; store age."""
    columns = {}
    if "amount_total_lag_1d" in panel.columns:
        yesterday = F.col("amount_total_lag_1d")
        columns["sales_per_sqm"] = yesterday / (F.col("size_sqm") + 1)
        columns["sales_per_checkout"] = yesterday / (F.col("num_checkouts") + 1)
    if {"opening_year", "year"} <= set(panel.columns):
        columns["store_age_years"] = F.col("year") - F.col("opening_year")
    return panel.withColumns(columns) if columns else panel


def add_payment_ratio(panel: DataFrame) -> DataFrame:
    if {"amount_cash", "amount_total"} <= set(panel.columns):
        return _with_history(panel, history.Wanted(share=CASH_SHARE))
    return panel


def add_calendar_phases(panel: DataFrame) -> DataFrame:
    """Payday window, days to the next payday and month phases."""
    day, length = F.dayofmonth(C.DAY), F.dayofmonth(F.last_day(C.DAY))
    return panel.withColumns(
        {
            "day_of_month": day,
            "days_in_month": length,
            "is_payday_window": (
                day.isin(14, 15, 16) | (day >= length - 1) | F.coalesce("is_payday", F.lit(False))
            ).cast("int"),
            "days_to_next_payday": F.when(day <= 15, 15 - day).otherwise(length - day),
            "is_month_start": (day <= 5).cast("int"),
            "is_month_end": (day >= length - 4).cast("int"),
        }
    )


def add_window_features(panel: DataFrame) -> DataFrame:
    """Lags, rolling frames and the payment ratio in one pass over the series, unless the grid made them while it unfolded."""
    wanted = window_features(panel.columns)
    return panel if set(wanted.names) <= set(panel.columns) else _with_history(panel, wanted)


def engineer_features(panel: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """Every feature except the fitted encodings.

    Pass the calendar separately to join it after the windows: the rows they sort and buffer are
    then half as wide. The panel must be dense in either case.
    """
    windowed = add_window_features(panel)
    dated = windowed if calendar is None else windowed.join(calendar, C.DAY)
    return dated.transform(add_store_ratios).transform(add_calendar_phases)


def split_column(splits: C.Splits, day: str = C.DAY) -> Column:
    """TRAIN / VAL / HOLDOUT by date, null outside all three."""
    d = F.col(day)
    return (
        F.when(d.between(F.lit(splits.start), F.lit(splits.train_end)), "TRAIN")
        .when(d.between(F.lit(splits.val_start), F.lit(splits.val_end)), "VAL")
        .when(d.between(F.lit(splits.holdout_start), F.lit(splits.holdout_end)), "HOLDOUT")
    )


def with_split(panel: DataFrame, splits: C.Splits) -> DataFrame:
    return panel.withColumn("split", split_column(splits))


def lag_of(column: str) -> int | None:
    """Days a lag column looks back; None for any other column."""
    found = re.search(r"_lag_(\d+)d$", column)
    return int(found.group(1)) if found else None


def gap_safe_columns(columns: Iterable[str], horizon: int = C.GAP_HORIZON) -> list[str]:
    """Static features plus lags that are still known ``horizon`` days ahead."""
    lags = [c for c in columns if (lag_of(c) or 0) >= horizon]
    return list(dict.fromkeys([*C.STATIC_FEATURES, *lags]))


def leak_reason(column: str, horizon: int = C.GAP_HORIZON) -> str | None:
    """Why a column is unavailable inside the blind window; None when it is safe."""
    days = lag_of(column)
    if column in C.MEASURES and column != "replenishment_signal":
        return "same-day reading"
    if days is not None and days < horizon:
        return "lag shorter than the horizon"
    if "_roll_" in column:
        return "window ends yesterday"
    if column in ("sales_per_sqm", "sales_per_checkout"):
        return "built on yesterday's sales"
    return None


def flag_leaks(panel: DataFrame, horizon: int = C.GAP_HORIZON) -> DataFrame:
    """(column, reason) for every column that is not gap-safe. Reads the schema only."""
    rows = [(c, leak_reason(c, horizon)) for c in panel.columns]
    return panel.sparkSession.createDataFrame(
        [r for r in rows if r[1]], "column string, reason string"
    )


def complete_cases(panel: DataFrame, features: Sequence[str], target: str = "replenishment_signal") -> DataFrame:
    """Rows with every feature and the target present."""
    return panel.dropna(subset=[*features, target])


def forget_outside(panel: DataFrame, first, last, look_back: int = 30) -> DataFrame:
    """Days needed to compute features of ``first``..``last``.

    A date filter is not pushed below a window, so cut the input with the look-back added
    and trim the result afterwards.
    """
    return panel.where(F.col(C.DAY).between(F.date_sub(F.lit(first), look_back), F.lit(last)))
