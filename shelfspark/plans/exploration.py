"""The exploration run: profile three tables into one document of long metric rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from shelfspark import contract as C
from shelfspark.operators import charts, columns, overview, profile, quality, readiness
from shelfspark.session import settle
from shelfspark.sources.documents import flatten

Tables = dict[str, DataFrame]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def overview_metrics(facts: DataFrame, stores: DataFrame, calendar: DataFrame) -> DataFrame:
    tables = {"transactions": facts, "stores": stores, "calendar": calendar}
    parts = []
    for name, df in tables.items():
        parts.append(flatten(columns.table_shape(df), "overview", f"tables_overview.{name}"))
        parts.append(flatten(columns.column_types(df), "overview", f"tables_overview.{name}", ["column"]))
        sizes = columns.cardinalities(df).select("column", "cardinality")
        parts.append(flatten(sizes, "overview", f"tables_overview.{name}", ["column"]))
    parts.append(flatten(overview.referential_match(facts, stores), "overview", "referential_integrity"))
    # What two sections are made of is written once.
    continuity = settle(overview.store_continuity(facts), "continuity")
    parts.append(flatten(overview.missing_store_days(facts, continuity), "overview", "temporal_continuity"))
    parts.append(flatten(overview.date_span(facts), "overview", "temporal_continuity"))
    parts.append(flatten(continuity, "overview", "temporal_continuity.stores", ["store_id"]))
    return _union(parts)


def audited_metrics(facts: DataFrame, stores: DataFrame) -> DataFrame:
    """The part of the document that a draft is held against (``audit.FACTS``), without computing the rest."""
    return _union(
        [
            flatten(columns.table_shape(facts), "overview", "tables_overview.transactions"),
            flatten(overview.referential_match(facts, stores), "overview", "referential_integrity"),
            flatten(columns.null_totals(facts), "quality", "missingness.transactions"),
            flatten(columns.duplicate_rows(facts), "quality", "exact_duplicates.transactions"),
            flatten(profile.payment_shares(facts), "profiling", "cash_vs_card"),
            flatten(profile.promotion_lift(facts, 2), "profiling", "promotion_impact"),
            flatten(readiness.grid_sparsity(facts), "ml_readiness", "temporal_sparsity"),
        ]
    )


def quality_metrics(facts: DataFrame, stores: DataFrame, calendar: DataFrame) -> DataFrame:
    parts = []
    for name, df in {"transactions": facts, "stores": stores, "calendar": calendar}.items():
        parts.append(flatten(columns.null_totals(df), "quality", f"missingness.{name}"))
        parts.append(flatten(columns.null_counts(df), "quality", f"missingness.{name}", ["column"]))
        parts.append(flatten(columns.duplicate_rows(df), "quality", f"exact_duplicates.{name}"))
        parts.append(flatten(columns.near_constant_columns(df), "quality", f"near_constant.{name}", ["column"]))
    grouped = columns.nulls_by(facts, "category", C.GROUPED_NULL_MEASURES)
    parts.append(flatten(grouped, "quality", "grouped_missingness", ["column", "category"]))
    bounds = settle(quality.iqr_bounds(facts), "bounds")
    parts.append(flatten(bounds, "quality", "iqr_outliers", ["column"]))
    parts.append(flatten(quality.iqr_outliers(facts, bounds=bounds), "quality", "iqr_outliers", ["column"]))
    return _union(parts)


def profiling_metrics(facts: DataFrame, stores: DataFrame) -> DataFrame:
    by_store = settle(profile.per_store(facts, stores), "by_store")
    return _union(
        [
            flatten(profile.describe_measures(facts), "profiling", "descriptive_stats", ["column"]),
            flatten(profile.payment_shares(facts), "profiling", "cash_vs_card"),
            flatten(profile.format_performance(facts, stores, by_store), "profiling", "format_performance", ["store_format"]),
            flatten(
                profile.socioeconomic_performance(facts, stores, by_store),
                "profiling",
                "socioeconomic_performance",
                ["socioeconomic_level"],
            ),
            flatten(profile.promotion_split(facts), "profiling", "promotion_impact", ["has_promotion"]),
            flatten(profile.promotion_lift(facts, 2), "profiling", "promotion_impact"),
            flatten(profile.signal_nulls(facts), "profiling", "replenishment_signal"),
            flatten(profile.signal_correlations(facts), "profiling", "replenishment_signal"),
            flatten(profile.recent_signal_nulls(facts), "profiling", "replenishment_signal"),
            flatten(profile.zero_inflation(facts), "profiling", "replenishment_signal"),
        ]
    )


def readiness_metrics(facts: DataFrame, stores: DataFrame) -> DataFrame:
    store_domains = ["region", "socioeconomic_level", "store_format"]
    return _union(
        [
            flatten(readiness.domain_sizes(facts, ["category"]), "features", "categorical", ["column"]),
            flatten(readiness.domain_sizes(stores, store_domains), "features", "categorical", ["column"]),
            flatten(readiness.repair_need(facts), "features", "imputation", ["column"]),
            flatten(readiness.collinear_pairs(facts), "ml_readiness", "collinear", ["var1", "var2"]),
            flatten(readiness.grid_sparsity(facts), "ml_readiness", "temporal_sparsity"),
        ]
    )


def statistics(facts: DataFrame, stores: DataFrame, calendar: DataFrame) -> DataFrame:
    """Every figure of the five sections: (section, path, value, text)."""
    return _union(
        [
            overview_metrics(facts, stores, calendar),
            quality_metrics(facts, stores, calendar),
            profiling_metrics(facts, stores),
            readiness_metrics(facts, stores),
        ]
    )


def chart_data(facts: DataFrame, stores: DataFrame, calendar: DataFrame) -> Tables:
    """One frame per chart."""
    return {
        "missing_matrix": charts.missing_share(facts, stores, calendar),
        "sales_time_series": charts.daily_totals(facts),
        "store_format_performance": charts.store_boxes(facts, stores),
        "calendar_impact": charts.event_means(facts, calendar),
        "correlation_matrix": readiness.correlation_matrix(facts),
    }

