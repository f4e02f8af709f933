"""Retail panel read from trade tables: line items become daily store x category facts.

Two grains share one definition. ``supplier`` takes every supplier as a store, so the number of
series grows with the data. ``region`` takes the supplier's region as the store; those series are
dense enough for models that need complete cases.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.contract import Splits
from shelfspark.session import settle
from shelfspark.sources.calendar import build_calendar

# The span of ship dates at every scale, and the last day the signal feed was up.
PERIOD_START = date(1995, 1, 2)
PERIOD_END = date(2001, 11, 4)
SIGNAL_END = date(2001, 11, 2)
SPLITS = Splits(
    PERIOD_START,
    date(2001, 8, 5),
    date(2001, 8, 6),
    date(2001, 10, 6),
    date(2001, 10, 7),
    PERIOD_END,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def trade_lines(spark: SparkSession, folder: str, grain: str = "supplier") -> DataFrame:
    """Line items with the store, category and day they belong to.

    No join carries a broadcast hint: part and supplier grow with the data, so the planner
    decides from their sizes and splits skewed keys at run time.
    """
    items = _table(spark, folder, "lineitem").select(
        F.to_date("l_shipdate").alias("date"),
        "l_partkey",
        "l_suppkey",
        "l_linestatus",
        F.col("l_quantity").cast("decimal(8,2)").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(8,2)").alias("price"),
        F.col("l_discount").cast("decimal(4,2)").alias("discount"),
    )
    parts = _table(spark, folder, "part").select("p_partkey", F.col("p_type").alias("category"))
    lines = items.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    if grain == "supplier":
        return lines.select(
            "date",
            F.concat(F.lit("STR_"), F.col("l_suppkey")).alias("store_id"),
            F.col("l_suppkey").alias("store_no"),
            "category",
            "l_linestatus",
            "quantity",
            "price",
            "discount",
        )
    nations = _table(spark, folder, "nation").join(
        _table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    homes = (
        _table(spark, folder, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.col("r_name").alias("store_id"), F.col("r_regionkey").alias("store_no"))
    )
    return lines.join(homes, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "date", "store_id", "store_no", "category", "l_linestatus", "quantity", "price", "discount"
    )


def _blanked(every: int, at: int, value: Column) -> Column:
    """Null out a reading on a fixed share of grid positions. No row is dropped."""
    return F.when(F.pmod(F.col("slot"), F.lit(every)) != at, value)


def facts_from_lines(lines: DataFrame) -> DataFrame:
    """Daily facts. Sums run over decimals, so they do not depend on the order of rows; eight
    digits a line keep the sums within the 18 digits that fit a machine word.

    The source has gaps but no nulls; a fixed arithmetic rule on the grid position blanks the
    readings that a till failure would lose.
    """
    status = F.col("l_linestatus")

    def total(value: Column, kind: str | None = None) -> Column:
        picked = value if kind is None else F.when(status == kind, value).otherwise(F.lit(0).cast("decimal(8,2)"))
        return F.sum(picked).cast("double")

    cells = lines.groupBy("date", "store_id", "category").agg(
        F.max("store_no").alias("store_no"),
        F.count("*").cast("int").alias("total_transactions"),
        F.count_if(status == "O").cast("int").alias("cash"),
        F.count_if(status == "F").cast("int").alias("card_transactions"),
        total(F.col("price")).alias("amount_total"),
        total(F.col("price"), "O").alias("cash_amount"),
        total(F.col("price"), "F").alias("amount_card"),
        total(F.col("quantity")).alias("units"),
        total((F.col("quantity") * (1 + F.col("discount"))).cast("decimal(8,4)")).alias("signal"),
    )
    day_no = F.datediff("date", F.lit(PERIOD_START))
    slot = 31 * day_no + 7 * F.col("store_no") + 3 * F.length("category")
    return cells.withColumn("slot", slot).select(
        "date",
        "store_id",
        "category",
        "total_transactions",
        _blanked(17, 0, F.col("cash")).alias("cash_transactions"),
        "card_transactions",
        "amount_total",
        _blanked(17, 0, F.col("cash_amount")).alias("amount_cash"),
        "amount_card",
        _blanked(33, 1, F.col("units")).alias("units_sold"),
        _blanked(41, 2, F.col("amount_total") / F.col("total_transactions")).alias("avg_ticket"),
        (F.pmod("slot", F.lit(10)) == 3).cast("int").alias("has_promotion"),
        F.when(F.col("date") <= F.lit(SIGNAL_END), F.col("signal")).alias("replenishment_signal"),
    )


def store_dimension(spark: SparkSession, folder: str, grain: str = "supplier") -> DataFrame:
    """Store attributes derived from the supplier rows."""
    suppliers = (
        _table(spark, folder, "supplier")
        .join(_table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(_table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    if grain == "supplier":
        base = suppliers.select(
            F.concat(F.lit("STR_"), F.col("s_suppkey")).alias("store_id"),
            F.col("r_name").alias("region"),
            F.col("s_nationkey").alias("level_no"),
            (F.floor(F.abs("s_acctbal")) + 500).cast("int").alias("size_sqm"),
            (F.col("s_nationkey") + 4).cast("int").alias("num_checkouts"),
        )
    else:
        base = suppliers.groupBy("r_name", "r_regionkey").agg(F.count("*").alias("n")).select(
            F.col("r_name").alias("store_id"),
            F.col("r_name").alias("region"),
            F.col("r_regionkey").alias("level_no"),
            (F.col("n") * 100).cast("int").alias("size_sqm"),
            (F.col("r_regionkey") + 4).cast("int").alias("num_checkouts"),
        )
    third, fourth = F.pmod("level_no", F.lit(3)), F.pmod("level_no", F.lit(4))
    return base.select(
        "store_id",
        F.when(third == 0, "Supercenter").when(third == 1, "Bodega").otherwise("Express").alias("store_format"),
        "region",
        "size_sqm",
        "num_checkouts",
        (F.col("level_no") + 1985).cast("int").alias("opening_year"),
        F.when(fourth == 0, "C").when(fourth == 1, "C+").when(fourth == 2, "B").otherwise("A/B").alias(
            "socioeconomic_level"
        ),
        (F.col("size_sqm") > 5000).alias("has_pharmacy"),
        (fourth == 1).alias("has_fuel_station"),
    )


@dataclass
class RetailTables:
    """The three inputs of every job; ``lines`` are the unaggregated source rows."""

    spark: SparkSession
    folder: str
    grain: str

    @cached_property
    def lines(self) -> DataFrame:
        return trade_lines(self.spark, self.folder, self.grain)

    @cached_property
    def facts(self) -> DataFrame:
        return facts_from_lines(self.lines)

    @cached_property
    def stores(self) -> DataFrame:
        return store_dimension(self.spark, self.folder, self.grain)

    @cached_property
    def calendar(self) -> DataFrame:
        return build_calendar(self.spark, PERIOD_START, PERIOD_END)

    def stored(self) -> RetailTables:
        """The same tables with the facts written once, for jobs that pass over them repeatedly:
        the line items are then read and aggregated a single time."""
        kept = RetailTables(self.spark, self.folder, self.grain)
        kept.__dict__["facts"] = settle(self.facts, "facts")
        return kept


def load_trade_panel(spark: SparkSession, folder: str, grain: str = "supplier") -> RetailTables:
    return RetailTables(spark, folder, grain)
