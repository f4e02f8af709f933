"""Reconciliation of claimed figures with measured ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PASSED, FAILED, MISSING = "PASSED", "FAILED", "MISSING"
# The ten facts a draft has to get right, and the decimals they are quoted with.
FACTS = (
    ("row count", "tables_overview.transactions.row_count", 0),
    ("referential match", "referential_integrity.referential_match_pct", 2),
    ("orphan stores", "referential_integrity.orphan_stores", 0),
    ("global null share", "missingness.transactions.global_null_percentage", 4),
    ("exact duplicates", "exact_duplicates.transactions.duplicate_rows", 0),
    ("total sales", "cash_vs_card.total_amount", 2),
    ("cash share", "cash_vs_card.cash_amount_share_pct", 2),
    ("card share", "cash_vs_card.card_amount_share_pct", 2),
    ("promotion lift", "promotion_impact.sales_lift_pct", 2),
    ("temporal sparsity", "temporal_sparsity.sparsity_pct", 2),
)


def facts_to_check(metrics: DataFrame) -> DataFrame:
    """(fact, path, digits) of the fixed facts."""
    rows = F.array(
        *[F.struct(F.lit(n).alias("fact"), F.lit(p).alias("path"), F.lit(d).alias("digits")) for n, p, d in FACTS]
    )
    return metrics.sparkSession.range(1).select(F.inline(rows))


def reconcile(claims: DataFrame, metrics: DataFrame) -> DataFrame:
    """(fact, path, claimed, measured, status): claims against metrics, to the quoted decimals.

    ``claims`` has fact, path, claimed, digits.
    """
    measured = metrics.select("path", F.col("value").alias("measured"))
    close = F.abs(F.col("claimed") - F.col("measured")) <= 0.5 * F.pow(F.lit(10.0), -F.col("digits")) + 1e-9
    status = F.when(F.col("measured").isNull(), MISSING).when(close, PASSED).otherwise(FAILED)
    return claims.join(measured, "path", "left").select("fact", "path", "claimed", "measured", status.alias("status"))


def numbers_in(draft: DataFrame) -> DataFrame:
    """(number) distinct figures quoted in a text, thousands separators removed."""
    tokens = draft.select(
        F.explode(F.regexp_extract_all("line", F.lit(r"(-?\d[\d,]*(?:\.\d+)?)"), F.lit(1))).alias("token")
    )
    return tokens.select(F.regexp_replace("token", ",", "").cast("double").alias("number")).distinct()


def audit_draft(draft: DataFrame, metrics: DataFrame) -> DataFrame:
    """(fact, path, measured, status): every fixed fact must occur in the draft as a whole number
    token, not as part of a longer figure."""
    expected = facts_to_check(metrics).join(metrics.select("path", "value"), "path", "left").withColumn(
        "quoted",
        F.when(F.col("digits") == 0, F.round("value", 0))
        .when(F.col("digits") == 2, F.round("value", 2))
        .otherwise(F.round("value", 4)),
    )
    found = numbers_in(draft).withColumn("hit", F.lit(True))
    status = (
        F.when(F.col("value").isNull(), MISSING).when(F.col("hit"), PASSED).otherwise(FAILED)
    )
    return expected.join(found, F.col("quoted") == F.col("number"), "left").select(
        "fact", "path", F.col("value").alias("measured"), status.alias("status")
    )


def verdict(audit: DataFrame) -> DataFrame:
    """(checks, passed, failed, approved)."""
    failed = F.count_if(F.col("status") != PASSED)
    return audit.agg(
        F.count("*").alias("checks"),
        F.count_if(F.col("status") == PASSED).alias("passed"),
        failed.alias("failed"),
        (failed == 0).alias("approved"),
    )
