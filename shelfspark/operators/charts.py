"""The numbers behind the charts; drawing them is left to a notebook."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.lookups import with_lookup
from shelfspark.operators.columns import null_counts
from shelfspark.operators.grid import with_calendar, with_stores
from shelfspark.operators.profile import money_sum
from shelfspark.operators.quantiles import long_values, quantile_columns

EVENT_FLAGS = ("is_payday", "is_buen_fin", "is_navidad_season", "is_holiday")


def missing_share(facts: DataFrame, stores: DataFrame, calendar: DataFrame) -> DataFrame:
    """Null share per column of the joined table, only above zero, largest first."""
    joined = facts.transform(with_stores, stores).transform(with_calendar, calendar)
    return (
        null_counts(joined)
        .where(F.col("null_count") > 0)
        .select("column", "null_percentage")
        .orderBy(F.desc("null_percentage"), "column")
    )


def daily_totals(facts: DataFrame) -> DataFrame:
    """Sales and transactions per day, in date order."""
    return (
        facts.groupBy("date")
        .agg(money_sum("amount_total").alias("amount_total"), F.sum("total_transactions").alias("total_transactions"))
        .orderBy("date")
    )


def box_statistics(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Quartiles and whiskers per group: whiskers end at the furthest reading within 1.5 IQR."""
    quartiles = quantile_columns(df, columns, {"q25": 0.25, "median": 0.5, "q75": 0.75}, by)
    keys = [*by, "column"]
    bounds = quartiles.select(*keys, F.struct("q25", "median", "q75", "n").alias("b"))
    reach = 1.5 * (F.col("b.q75") - F.col("b.q25"))
    inside = F.col("value").between(F.col("b.q25") - reach, F.col("b.q75") + reach)
    values = long_values(df.dropna(subset=list(by)) if by else df, columns, by)
    return (
        with_lookup(values, bounds, keys)
        .groupBy(*keys, "b")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
        .select(*keys, "b.n", "b.q25", "b.median", "b.q75", "whisker_low", "whisker_high", "outliers")
    )


def store_boxes(facts: DataFrame, stores: DataFrame) -> DataFrame:
    """Box statistics of sales and ticket by store format and socioeconomic level."""
    joined = with_stores(
        facts.select("store_id", "amount_total", "avg_ticket"),
        stores.select("store_id", "store_format", "socioeconomic_level"),
    )
    return box_statistics(joined, ["amount_total", "avg_ticket"], ["store_format", "socioeconomic_level"])


def event_means(facts: DataFrame, calendar: DataFrame, flags: Sequence[str] = EVENT_FLAGS) -> DataFrame:
    """(event, state, mean_amount_total) with each calendar flag on and off, in long form.

    Facts are reduced to one row per day before they meet the calendar.
    """
    days = facts.groupBy("date").agg(
        F.sum(F.col("amount_total").cast("decimal(18,2)")).alias("total"), F.count("amount_total").alias("n")
    )
    dated = days.transform(with_calendar, calendar)

    def row(flag: str, on: bool):
        hit = F.col(flag) == on
        return F.struct(
            F.lit(flag).alias("event"),
            F.lit("active" if on else "inactive").alias("state"),
            (F.sum(F.when(hit, F.col("total"))).cast("double") / F.sum(F.when(hit, F.col("n")))).alias(
                "mean_amount_total"
            ),
        )

    rows = [row(f, on) for f in flags for on in (True, False)]
    return dated.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def value_order(df: DataFrame, column: str) -> DataFrame:
    """Category counts, most frequent first."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)
