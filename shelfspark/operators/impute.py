"""Point-of-sale repairs: accounting identities, then medians of the training window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark import contract as C
from shelfspark.functions.lookups import with_lookup
from shelfspark.operators.quantiles import median_columns

REPAIRED = ("units_sold", "avg_ticket")


def cash_count_identity(facts: DataFrame) -> DataFrame:
    """Missing cash count = total - card; stays null when card is null."""
    other = F.col("total_transactions") - F.col("card_transactions")
    return facts.withColumn("cash_transactions", F.coalesce("cash_transactions", other))


def cash_amount_identity(facts: DataFrame) -> DataFrame:
    """Missing cash amount = total - card; stays null when card is null."""
    other = F.col("amount_total") - F.col("amount_card")
    return facts.withColumn("amount_cash", F.coalesce("amount_cash", other))


def recompute_ticket(facts: DataFrame) -> DataFrame:
    """Missing average ticket from amount and count, where there were transactions."""
    ticket = F.when(F.col("total_transactions") > 0, F.col("amount_total") / F.col("total_transactions"))
    return facts.withColumn("avg_ticket", F.coalesce("avg_ticket", ticket))


def in_training(train_end=None, day: str = C.DAY) -> Column:
    """Rows medians may learn from; every row without a bound."""
    return F.lit(True) if train_end is None else F.col(day) <= F.lit(train_end)


def training_rows(facts: DataFrame, train_end=None) -> DataFrame:
    return facts.where(in_training(train_end))


def with_weekday_medians(facts: DataFrame, train_end=None) -> DataFrame:
    """``<column>_weekday_median``: training median of the row's (store, category, weekday).

    A group holds one reading a week, so the built-in exact median is bounded by the calendar.
    On rows already partitioned by series the finer grouping needs no shuffle.
    """
    group = Window.partitionBy(*C.KEYS, "_weekday")
    known = in_training(train_end)
    return (
        facts.withColumn("_weekday", F.weekday(C.DAY))
        .withColumns(
            {f"{c}_weekday_median": F.median(F.when(known, F.col(c).cast("double"))).over(group) for c in REPAIRED}
        )
        .drop("_weekday")
    )


def weekday_medians(facts: DataFrame, train_end=None) -> DataFrame:
    """The group medians as a table (store, category, day_of_week)."""
    return (
        training_rows(facts, train_end)
        .groupBy(*C.KEYS, F.weekday(C.DAY).alias("day_of_week"))
        .agg(*[F.median(F.col(c).cast("double")).alias(f"{c}_median") for c in REPAIRED])
    )


def category_medians(facts: DataFrame, train_end=None) -> DataFrame:
    """Training median by category. A category may hold a third of all rows: see quantiles."""
    return median_columns(training_rows(facts, train_end), REPAIRED, ["category"])


def fill_weekday_medians(facts: DataFrame, train_end=None) -> DataFrame:
    filled = with_weekday_medians(facts, train_end)
    return filled.withColumns(
        {c: F.coalesce(c, f"{c}_weekday_median") for c in REPAIRED}
    ).drop(*[f"{c}_weekday_median" for c in REPAIRED])


def with_category_medians(rows: DataFrame, facts: DataFrame, train_end=None) -> DataFrame:
    """``<column>_median`` of the row's category, learned from ``facts``."""
    return with_lookup(rows, category_medians(facts, train_end), ["category"])


def fill_medians(rows: DataFrame, train_end=None, facts: DataFrame | None = None) -> DataFrame:
    """Weekday medians, then category medians for what is still missing.

    ``facts`` are the readings the category medians learn from (``rows`` by default). With a
    training bound both medians come from the readings before any fill. Without one the category
    medians see the weekday fills, because then the frame is its own reference.
    """
    facts = rows if facts is None else facts
    reference = facts if train_end is not None else fill_weekday_medians(facts)
    filled = with_category_medians(fill_weekday_medians(rows, train_end), reference, train_end)
    medians = [f"{c}_median" for c in REPAIRED]
    return filled.withColumns({c: F.coalesce(c, m) for c, m in zip(REPAIRED, medians, strict=True)}).drop(*medians)


def apply_identities(facts: DataFrame) -> DataFrame:
    return facts.transform(cash_count_identity).transform(cash_amount_identity).transform(recompute_ticket)


def repair_readings(facts: DataFrame, train_end=None) -> DataFrame:
    """The full repair: identities, ticket, weekday medians, category medians."""
    return fill_medians(apply_identities(facts), train_end)


def repair_coverage(facts: DataFrame, train_end=None) -> DataFrame:
    """How many nulls each rule filled: (column, nulls_before, by_identity, by_weekday_median,
    by_category_median, nulls_after)."""
    before = apply_identities(
        facts.withColumns({f"{c}_raw": F.col(c) for c in ("cash_transactions", "amount_cash", *REPAIRED)})
    )
    marked = with_category_medians(with_weekday_medians(before, train_end), before, train_end)

    def counts(column: str) -> Column:
        raw_null = F.col(f"{column}_raw").isNull()
        still = F.col(column).isNull()
        week = F.col(f"{column}_weekday_median") if column in REPAIRED else F.lit(None)
        cat = F.col(f"{column}_median") if column in REPAIRED else F.lit(None)
        return F.struct(
            F.lit(column).alias("column"),
            F.count_if(raw_null).alias("nulls_before"),
            F.count_if(raw_null & ~still).alias("by_identity"),
            F.count_if(still & week.isNotNull()).alias("by_weekday_median"),
            F.count_if(still & week.isNull() & cat.isNotNull()).alias("by_category_median"),
            F.count_if(still & week.isNull() & cat.isNull()).alias("nulls_after"),
        )

    tracked = ("cash_transactions", "amount_cash", *REPAIRED)
    return marked.agg(F.array(*[counts(c) for c in tracked]).alias("rows")).select(F.inline("rows"))
