"""The data contract: table schemas, key names and the fixed values results depend on."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import types as T

KEYS = ("store_id", "category")
DAY = "date"

TRANSACTIONS = T.StructType(
    [
        T.StructField("date", T.DateType(), False),
        T.StructField("store_id", T.StringType(), False),
        T.StructField("category", T.StringType(), False),
        T.StructField("total_transactions", T.IntegerType()),
        T.StructField("cash_transactions", T.IntegerType()),
        T.StructField("card_transactions", T.IntegerType()),
        T.StructField("amount_total", T.DoubleType()),
        T.StructField("amount_cash", T.DoubleType()),
        T.StructField("amount_card", T.DoubleType()),
        T.StructField("units_sold", T.DoubleType()),
        T.StructField("avg_ticket", T.DoubleType()),
        T.StructField("has_promotion", T.IntegerType()),
        T.StructField("replenishment_signal", T.DoubleType()),
    ]
)

STORES = T.StructType(
    [
        T.StructField("store_id", T.StringType(), False),
        T.StructField("store_format", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("size_sqm", T.IntegerType()),
        T.StructField("num_checkouts", T.IntegerType()),
        T.StructField("opening_year", T.IntegerType()),
        T.StructField("socioeconomic_level", T.StringType()),
        T.StructField("has_pharmacy", T.BooleanType()),
        T.StructField("has_fuel_station", T.BooleanType()),
    ]
)

CALENDAR = T.StructType(
    [
        T.StructField("date", T.DateType(), False),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("day_name", T.StringType()),
        T.StructField("week_of_year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("quarter", T.IntegerType()),
        T.StructField("season", T.StringType()),
        T.StructField("is_holiday", T.BooleanType()),
        T.StructField("holiday_name", T.StringType()),
        T.StructField("is_payday", T.BooleanType()),
        T.StructField("is_weekend", T.BooleanType()),
        T.StructField("is_navidad_season", T.BooleanType()),
        T.StructField("is_buen_fin", T.BooleanType()),
        T.StructField("is_semana_santa", T.BooleanType()),
    ]
)

# Fixed values. They have to equal the published ones for results to agree.
ZERO_FILLED = (
    "total_transactions",
    "cash_transactions",
    "card_transactions",
    "amount_total",
    "amount_cash",
    "amount_card",
)
MEASURES = ZERO_FILLED + ("units_sold", "avg_ticket", "replenishment_signal")
LAG_DAYS = (1, 7, 14, 28)
LAG_TARGETS = ("amount_total", "units_sold", "replenishment_signal")
ROLL_DAYS = (7, 14, 28)
ROLL_TARGETS = ("amount_total", "units_sold")
GAP_HORIZON = 7
SEASON_LENGTH = 7
CV_WINDOWS = 8
UNIT_VALUE_MXN = 150.0
OVERSTOCK_RATE = 0.15
STOCKOUT_RATE = 0.30
SOCIOECONOMIC_ORDER = {"C": 0, "C+": 1, "B": 2, "A/B": 3}
OUTLIER_MEASURES = ("amount_total", "units_sold", "avg_ticket", "amount_cash", "amount_card")
COLLINEAR_MEASURES = ZERO_FILLED + ("units_sold",)
GROUPED_NULL_MEASURES = (
    "cash_transactions",
    "amount_cash",
    "units_sold",
    "avg_ticket",
    "replenishment_signal",
)
STATIC_FEATURES = (
    "is_payday_window",
    "days_to_next_payday",
    "is_month_start",
    "is_month_end",
    "category_target_enc",
    "store_format_target_enc",
    "socioeconomic_level_ord",
    "size_sqm",
    "num_checkouts",
    "is_holiday",
    "is_payday",
    "is_weekend",
    "is_buen_fin",
    "is_navidad_season",
)
FOREST_FEATURES = ("amount_total", "card_transactions", "total_transactions")
FOREST_CONTAMINATION = 0.01


@dataclass(frozen=True)
class Splits:
    """Chronological split bounds, all inclusive."""

    start: date
    train_end: date
    val_start: date
    val_end: date
    holdout_start: date
    holdout_end: date

    @property
    def holdout_days(self) -> int:
        return (self.holdout_end - self.holdout_start).days + 1


# Bounds of the published retail data set.
RETAIL_SPLITS = Splits(
    date(2023, 1, 1),
    date(2023, 11, 30),
    date(2023, 12, 1),
    date(2024, 1, 31),
    date(2024, 2, 1),
    date(2024, 2, 29),
)
