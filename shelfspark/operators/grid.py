"""Dense panel construction: gap filling, outage flags, zero fills, dimension joins."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark import contract as C
from shelfspark.functions import history
from shelfspark.functions.lookups import lookup_list
from shelfspark.operators.features import history_fields
from shelfspark.operators.impute import apply_identities, fill_medians
from shelfspark.session import series_partitions


def domains(facts: DataFrame, stores: DataFrame, calendar: DataFrame) -> dict[str, DataFrame]:
    """The three distinct lists that span the grid."""
    return {
        "date": calendar.select("date").distinct(),
        "store_id": stores.select("store_id").distinct(),
        "category": facts.select("category").where(F.col("category").isNotNull()).distinct(),
    }


def series_keys(stores: DataFrame, categories: DataFrame) -> DataFrame:
    """Every store row times every category, by unfolding the category list on each store."""
    return stores.withColumn("category", F.explode(lookup_list(categories, "category")))


def _span(calendar: DataFrame) -> tuple[Column, Column]:
    bounds = calendar.agg(F.struct(F.min(C.DAY).alias("first"), F.max(C.DAY).alias("last"))).scalar()
    return bounds["first"], bounds["last"]


def open_series(
    facts: DataFrame, stores: DataFrame, calendar: DataFrame, categories: DataFrame | None = None
) -> DataFrame:
    """Facts plus one opening row per series that carries the store's attributes, partitioned by
    series. ``_fact`` tells facts from opening rows.

    This is the only shuffle of the panel, and it moves facts, not grid cells.
    """
    first, last = _span(calendar)
    if categories is None:
        categories = domains(facts, stores, calendar)["category"]
    heads = series_keys(stores, categories).withColumn(C.DAY, first).withColumn("_fact", F.lit(0))
    known = facts.where(F.col("category").isNotNull() & F.col(C.DAY).between(first, last))
    rows = known.withColumn("_fact", F.lit(1)).unionByName(heads, allowMissingColumns=True)
    return rows.repartition(series_partitions(facts.sparkSession), *C.KEYS)


def unfold_gaps(rows: DataFrame, calendar: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Each row unfolds the empty days up to the next row of its series.

    The product of the domain lists is never shuffled or joined, and what follows can window over
    the partitioning by series that the rows already have. The opening row sorts first and hands
    its attributes to the whole series; a series without one has a store outside the dimension and
    drops out. Several facts on one cell all stay.
    """
    _, last = _span(calendar)
    in_order = Window.partitionBy(*C.KEYS).orderBy(C.DAY, "_fact")
    attributes = [c for c in rows.columns if c not in (*measures, *C.KEYS, C.DAY, "_fact")]
    day = F.col(C.DAY)
    gap = F.when(F.col("_next") > day, F.sequence(day, F.date_sub("_next", 1)))
    covered = F.when(F.col("_fact") == 1, F.coalesce(gap, F.array(day))).otherwise(gap)
    observed = (F.col("_pos") == 0) & (F.col("_fact") == 1)
    return (
        rows.select(
            *C.KEYS,
            C.DAY,
            "_fact",
            *measures,
            F.coalesce(F.lead(C.DAY).over(in_order), F.date_add(last, 1)).alias("_next"),
            F.first(F.struct("_fact", *attributes)).over(in_order).alias("_head"),
        )
        .where(F.col("_head._fact") == 0)
        .select(*C.KEYS, "_head", *measures, "_fact", F.posexplode(covered).alias("_pos", C.DAY))
        .select(
            C.DAY,
            *C.KEYS,
            *[F.col(f"_head.{a}").alias(a) for a in attributes],
            *[F.when(observed, F.col(m)).alias(m) for m in measures],
        )
    )


def unfold_with_history(
    rows: DataFrame,
    calendar: DataFrame,
    measures: Sequence[str],
    wanted: history.Wanted,
    keep: Sequence[str] | None = None,
    zeros: Sequence[str] = C.ZERO_FILLED,
) -> DataFrame:
    """``unfold_gaps``, the days of the calendar, ``flag_outages``, ``zero_fill`` and the ``wanted`` columns of earlier days in
    one kernel per series.

    Only facts and opening rows are sorted and handed over; the cells come to be in NumPy, where the windows need no
    further sort of all cells. ``keep`` names the attributes and measures that are handed on, all by default: the planner
    prunes nothing through a kernel.
    """
    attributes = [c for c in rows.columns if c not in (*measures, *C.KEYS, C.DAY, "_fact")]
    how = history.Cells(C.DAY, C.KEYS, tuple(attributes), tuple(measures), tuple(zeros), "pos_outage_flag", "amount_total")
    if keep is not None:
        every = (*attributes, *measures, how.flag)
        how = replace(how, dropped=tuple(c for c in every if c not in keep and c not in wanted.sources))
    cells = [T.StructField("date", T.DateType()), *(rows.schema[c] for c in (*C.KEYS, *attributes, *measures)), T.StructField(how.flag, T.IntegerType())]
    kept = [f for f in cells if keep is None or f.name in (C.DAY, *C.KEYS, *keep)]
    schema = T.StructType([*kept, *history_fields(rows.schema, wanted)])
    names = schema.fieldNames()

    def run(own: pa.Table) -> pa.Table:
        return history.with_history(history.unfolded(own, how), wanted).select(names)

    opened = rows.withColumn("_days", F.when(F.col("_fact") == 0, lookup_list(calendar, C.DAY)))
    return opened.groupBy(*C.KEYS).applyInArrow(run, schema)


def unfold_vectors(rows: DataFrame, calendar: DataFrame, end, target: str = "replenishment_signal") -> DataFrame:
    """(keys, unique_id, first_ds, y[]): the series of ``build_series`` as vectors, one value for every day up to ``end``.

    Only facts and opening rows are sorted and handed over; cells, fills and vectors come to be in one kernel per series.
    """
    how = history.Cells(C.DAY, C.KEYS, (), (target,), (), "pos_outage_flag", target, ("pos_outage_flag",))
    keys = [rows.schema[c] for c in C.KEYS]
    schema = T.StructType([*keys]).add("unique_id", T.StringType()).add("first_ds", T.DateType()).add("y", T.ArrayType(T.DoubleType()))
    names, last = schema.fieldNames(), (end - date(1970, 1, 1)).days

    def run(own: pa.Table) -> pa.Table:
        return history.vector(own, how, target, last, "unique_id", names)

    opened = rows.select(
        *C.KEYS,
        C.DAY,
        "_fact",
        target,
        F.concat_ws("_", *[F.col(k).cast("string") for k in C.KEYS]).alias("unique_id"),
        F.when(F.col("_fact") == 0, lookup_list(calendar, C.DAY)).alias("_days"),
    )
    return opened.groupBy(*C.KEYS).applyInArrow(run, schema)


def densify(
    facts: DataFrame, stores: DataFrame, calendar: DataFrame, categories: DataFrame | None = None
) -> DataFrame:
    """All calendar days of every (store, category), with facts where there are any.

    Equal to left-joining facts, then stores, onto the product of the three domain lists.
    """
    measures = [c for c in facts.columns if c not in (*C.KEYS, C.DAY)]
    cells = unfold_gaps(open_series(facts, stores, calendar, categories), calendar, measures)
    return cells.join(calendar.select(C.DAY).distinct(), C.DAY, "left_semi")


def flag_outages(grid: DataFrame) -> DataFrame:
    """1 where no total arrived for the cell, also when a fact row came without one."""
    return grid.withColumn("pos_outage_flag", F.col("amount_total").isNull().cast("int"))


def zero_fill(panel: DataFrame) -> DataFrame:
    """Empty cells sold nothing. Units, ticket, promotion and signal stay unknown."""
    return panel.fillna(0, subset=list(C.ZERO_FILLED))


def with_stores(panel: DataFrame, stores: DataFrame) -> DataFrame:
    """Store attributes. The dimension grows with the chain, so its join is left to the planner."""
    return panel.join(stores, "store_id", "left")


def with_calendar(panel: DataFrame, calendar: DataFrame) -> DataFrame:
    """Calendar attributes."""
    return panel.join(calendar, "date", "left")


def repaired_rows(
    facts: DataFrame, stores: DataFrame, calendar: DataFrame, train_end=None, categories: DataFrame | None = None
) -> DataFrame:
    """Repaired facts and opening rows by series, before they unfold."""
    known = apply_identities(facts)
    return open_series(known, stores, calendar, categories).transform(fill_medians, train_end, known)


def repaired_grid(
    facts: DataFrame,
    stores: DataFrame,
    calendar: DataFrame,
    train_end=None,
    categories: DataFrame | None = None,
    wanted: history.Wanted | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Repair facts, densify, flag outages, zero-fill; store attributes included.

    Only facts are repaired, so empty cells never receive medians. From the partitioning by
    series on there is no further shuffle, up to and including the feature windows. With ``wanted`` the cells are those of
    the calendar's own days and get these columns of earlier days, next to those to ``keep``.
    """
    measures = [c for c in facts.columns if c not in (*C.KEYS, C.DAY)]
    rows = repaired_rows(facts, stores, calendar, train_end, categories)
    if wanted is not None:
        return unfold_with_history(rows, calendar, measures, wanted, keep)
    return unfold_gaps(rows, calendar, measures).transform(flag_outages).transform(zero_fill)


def master_panel(
    facts: DataFrame,
    stores: DataFrame,
    calendar: DataFrame,
    train_end=None,
    categories: DataFrame | None = None,
    wanted: history.Wanted | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The repaired grid with calendar attributes; days the calendar skips drop out."""
    return repaired_grid(facts, stores, calendar, train_end, categories, wanted, keep).join(calendar, C.DAY)
