"""Referential integrity and temporal continuity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ids(df: DataFrame, key: str = "store_id") -> DataFrame:
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def orphan_stores(facts: DataFrame, stores: DataFrame, key: str = "store_id") -> DataFrame:
    """Stores (or other keys) that sold something but are missing from the dimension."""
    return _ids(facts, key).join(_ids(stores, key), key, "left_anti")


def idle_stores(facts: DataFrame, stores: DataFrame, key: str = "store_id") -> DataFrame:
    """Stores (or other keys) of the dimension without any fact."""
    return _ids(stores, key).join(_ids(facts, key), key, "left_anti")


def referential_match(facts: DataFrame, stores: DataFrame) -> DataFrame:
    """Distinct stores on each side, orphans, idle stores and the match share: one union, one
    grouping by store."""
    sides = _ids(facts).select("store_id", F.lit(1).alias("sold"), F.lit(0).alias("listed")).unionByName(
        _ids(stores).select("store_id", F.lit(0).alias("sold"), F.lit(1).alias("listed"))
    )
    ids = sides.groupBy("store_id").agg(F.max("sold").alias("sold"), F.max("listed").alias("listed"))
    sold, listed = F.col("sold") == 1, F.col("listed") == 1
    return ids.agg(
        F.count_if(sold).alias("stores_in_facts"),
        F.count_if(listed).alias("stores_in_dimension"),
        F.count_if(sold & ~listed).alias("orphan_stores"),
        F.count_if(listed & ~sold).alias("stores_without_facts"),
        (F.count_if(sold & listed) / F.greatest(F.count_if(listed), F.lit(1)) * 100).alias("referential_match_pct"),
    )


def date_span(facts: DataFrame, day: str = "date") -> DataFrame:
    """(first_day, last_day, expected_days)."""
    return facts.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day")).withColumn(
        "expected_days", (F.datediff("last_day", "first_day") + 1).cast("long")
    )


def store_continuity(facts: DataFrame) -> DataFrame:
    """Active and missing days per store against the global span.

    One row per (store, day) first, so a store with most of the rows is reduced before its days
    are counted.
    """
    days = facts.where(F.col("store_id").isNotNull()).select("store_id", "date").distinct()
    per_store = days.groupBy("store_id").agg(
        F.min("date").alias("min_date"), F.max("date").alias("max_date"), F.count("date").alias("active_days")
    )
    expected = per_store.agg(
        (F.datediff(F.max("max_date"), F.min("min_date")) + 1).cast("long")
    ).scalar()
    return (
        per_store.withColumn("expected_days", expected)
        .withColumn("missing_days", F.col("expected_days") - F.col("active_days"))
        .withColumn("continuity_pct", F.col("active_days") / F.col("expected_days") * 100)
    )


def missing_store_days(facts: DataFrame, continuity: DataFrame | None = None) -> DataFrame:
    """(stores_count, total_missing_store_days), from ``store_continuity`` of the facts."""
    return (store_continuity(facts) if continuity is None else continuity).agg(
        F.count("*").alias("stores_count"),
        F.sum(F.greatest("missing_days", F.lit(0))).alias("total_missing_store_days"),
    )
