"""Descriptive statistics and retail business metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark import contract as C
from shelfspark.operators.columns import numeric_describe
from shelfspark.operators.grid import with_stores
from shelfspark.operators.quantiles import median_columns, quantile_columns
from shelfspark.operators.sketches import merged_quantiles, part_states

PERCENTILES = {"p5": 0.05, "p25": 0.25, "median_p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}


def money_sum(column: str) -> Column:
    """Sum over decimals, so it does not depend on the order of rows; null when all are null."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


def percentiles(facts: DataFrame, columns: Sequence[str] = C.MEASURES) -> DataFrame:
    return quantile_columns(facts, columns, PERCENTILES).drop("n")


def percentiles_approx(facts: DataFrame, columns: Sequence[str] = C.MEASURES) -> DataFrame:
    """The same columns from states per day, merged, for exploratory use: ranks are off by ``sketches.rank_bound()`` at most."""
    found = merged_quantiles(part_states(facts, columns), list(PERCENTILES.values()))
    return found.groupBy("column").agg(*(F.max(F.when(F.col("p") == p, F.col("q"))).alias(name) for name, p in PERCENTILES.items()))


def describe_measures(facts: DataFrame, columns: Sequence[str] = C.MEASURES) -> DataFrame:
    """Count, moments, extremes, shape and percentiles per measure."""
    return numeric_describe(facts, columns).drop("range").join(percentiles(facts, columns), "column")


def payment_shares(facts: DataFrame) -> DataFrame:
    """Cash and card totals and their shares, by amount and by count."""
    totals = facts.agg(
        money_sum("amount_total").alias("total_amount"),
        money_sum("amount_cash").alias("total_amount_cash"),
        money_sum("amount_card").alias("total_amount_card"),
        F.sum("total_transactions").alias("total_transactions"),
        F.sum("cash_transactions").alias("total_cash_transactions"),
        F.sum("card_transactions").alias("total_card_transactions"),
    )

    def share(part: str, whole: str) -> Column:
        return F.try_divide(part, whole) * 100

    return totals.withColumns(
        {
            "cash_amount_share_pct": share("total_amount_cash", "total_amount"),
            "card_amount_share_pct": share("total_amount_card", "total_amount"),
            "cash_tx_share_pct": share("total_cash_transactions", "total_transactions"),
            "card_tx_share_pct": share("total_card_transactions", "total_transactions"),
        }
    )


def per_store(facts: DataFrame, stores: DataFrame) -> DataFrame:
    """Additive parts per store, so the store attributes join one row per store."""
    parts = facts.groupBy("store_id").agg(
        F.sum(F.col("amount_total").cast("decimal(18,2)")).alias("sales"),
        F.count("amount_total").alias("sales_n"),
        F.sum(F.col("amount_cash").cast("decimal(18,2)")).alias("cash"),
        F.sum("avg_ticket").alias("ticket"),
        F.count("avg_ticket").alias("ticket_n"),
        F.sum(F.col("units_sold").cast("decimal(18,2)")).alias("units"),
        F.count("units_sold").alias("units_n"),
    )
    return with_stores(parts, stores)


def _group_means(parts: DataFrame, key: str) -> DataFrame:
    return parts.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count("*").alias("store_count"),
        F.sum("sales").cast("double").alias("total_sales_mxn"),
        F.try_divide(F.sum("sales").cast("double"), F.sum("sales_n")).alias("mean_daily_sales_mxn"),
        F.try_divide(F.sum("ticket"), F.sum("ticket_n")).alias("mean_avg_ticket_mxn"),
        F.try_divide(F.sum("units").cast("double"), F.sum("units_n")).alias("mean_units_sold"),
        (F.try_divide(F.sum("cash").cast("double"), F.sum("sales").cast("double")) * 100).alias("cash_share_pct"),
    )


def format_performance(facts: DataFrame, stores: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """Stores, sales, tickets and units by store format, with exact medians. ``parts`` are those of ``per_store``."""
    means = _group_means(per_store(facts, stores) if parts is None else parts, "store_format").drop("cash_share_pct")
    medians = median_columns(
        with_stores(facts.select("store_id", "amount_total", "avg_ticket"), stores.select("store_id", "store_format")),
        ["amount_total", "avg_ticket"],
        ["store_format"],
    )
    return means.join(medians, "store_format").withColumnsRenamed(
        {"amount_total_median": "median_daily_sales_mxn", "avg_ticket_median": "median_avg_ticket_mxn"}
    )


def socioeconomic_performance(facts: DataFrame, stores: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """Stores, sales, ticket and cash share by socioeconomic level. ``parts`` are those of ``per_store``."""
    return _group_means(per_store(facts, stores) if parts is None else parts, "socioeconomic_level").drop("mean_units_sold")


def promotion_split(facts: DataFrame) -> DataFrame:
    """Records, share, sales, units and ticket with and without promotion."""
    known = facts.where(F.col("has_promotion").isNotNull())
    rows = facts.agg(F.count("*")).scalar()
    means = known.groupBy("has_promotion").agg(
        F.count("*").alias("record_count"),
        (F.count("*") / rows * 100).alias("record_pct"),
        F.try_divide(money_sum("amount_total"), F.count("amount_total")).alias("mean_amount_total"),
        F.try_divide(money_sum("units_sold"), F.count("units_sold")).alias("mean_units_sold"),
        F.avg("avg_ticket").alias("mean_avg_ticket"),
    )
    medians = median_columns(known, ["amount_total"], ["has_promotion"])
    return means.join(medians, "has_promotion").withColumnRenamed("amount_total_median", "median_amount_total")


def promotion_lift(facts: DataFrame, round_means_to: int | None = None) -> DataFrame:
    """Relative difference of mean sales with promotion; means can be rounded first."""

    def mean(flag: int) -> Column:
        value = F.avg(F.when(F.col("has_promotion") == flag, F.col("amount_total").cast("decimal(18,2)"))).cast("double")
        return value if round_means_to is None else F.round(value, round_means_to)

    return facts.agg(mean(1).alias("with_promotion"), mean(0).alias("without_promotion")).withColumn(
        "sales_lift_pct",
        F.try_divide(F.col("with_promotion") - F.col("without_promotion"), F.col("without_promotion")) * 100,
    )


def signal_nulls(facts: DataFrame, target: str = "replenishment_signal") -> DataFrame:
    missing = F.count_if(F.col(target).isNull())
    return facts.agg(missing.alias("null_count"), (F.try_divide(missing, F.count("*")) * 100).alias("null_pct"))


def signal_correlations(facts: DataFrame, target: str = "replenishment_signal") -> DataFrame:
    """Pearson correlation with sales and units over complete pairs."""
    return facts.agg(
        F.corr(target, "amount_total").alias("correlation_with_amount_total"),
        F.corr(target, "units_sold").alias("correlation_with_units_sold"),
    )


def recent_signal_nulls(facts: DataFrame, days: int = 7, target: str = "replenishment_signal") -> DataFrame:
    """Null share from ``days`` before the newest date on, both ends included."""
    since = facts.agg(F.date_sub(F.max(C.DAY), days)).scalar()
    recent = facts.where(F.col(C.DAY) >= since)
    return recent.agg(
        F.count("*").alias("rows"),
        (F.try_divide(F.count_if(F.col(target).isNull()), F.count("*")) * 100).alias("recent_null_pct"),
    )


def zero_inflation(facts: DataFrame, target: str = "replenishment_signal") -> DataFrame:
    """Share of zeros among the known signal readings."""
    known = F.count(target)
    zeros = F.count_if(F.col(target) == 0)
    return facts.agg(
        known.alias("known"), zeros.alias("zeros"), (F.try_divide(zeros, known) * 100).alias("zero_inflation_pct")
    )


def signal_distribution(
    facts: DataFrame, by: Sequence[str] = ("category",), target: str = "replenishment_signal", states: DataFrame | None = None
) -> DataFrame:
    """Per group the known readings, the zeros among them and the percentiles of PERCENTILES: (by..., column, n, zeros, p, q).

    Percentiles come from ``states`` per day (see ``sketches``), which can be kept and extended; without them they are made here.
    """
    states = part_states(facts, [target], [*by, C.DAY]) if states is None else states
    zeros = facts.groupBy(*by).agg(F.count_if(F.col(target) == 0).alias("zeros"))
    return merged_quantiles(states, list(PERCENTILES.values()), by).join(zeros, [*by])
