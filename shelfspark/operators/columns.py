"""Column-level profiles: null counts, value counts, shapes, histograms.

Most of them read one of two small tables: ``null_counts`` (one aggregation over all columns) and
``value_counts`` (one shuffle keyed by column and value, pre-aggregated before it).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.lookups import with_lookup
from shelfspark.functions.moments import sample_kurtosis, sample_skewness
from shelfspark.operators.quantiles import long_values, quantile_columns


def table_shape(df: DataFrame) -> DataFrame:
    """(row_count, col_count)."""
    return df.agg(F.count("*").alias("row_count"), F.lit(len(df.columns)).alias("col_count"))


def column_types(df: DataFrame) -> DataFrame:
    """(column, type) read off the schema."""
    return df.sparkSession.createDataFrame(df.dtypes, "column string, type string")


def null_counts(df: DataFrame) -> DataFrame:
    """(column, total_rows, null_count, null_percentage) in one aggregation."""
    rows = F.count("*")
    per_column = [
        F.struct(F.lit(c).alias("column"), rows.alias("total_rows"), (rows - F.count(c)).alias("null_count"))
        for c in df.columns
    ]
    return (
        df.agg(F.array(*per_column).alias("rows"))
        .select(F.inline("rows"))
        .withColumn("null_percentage", F.try_divide("null_count", "total_rows") * 100)
    )


def null_totals(df: DataFrame) -> DataFrame:
    """Null cells, cells and global null share of a table."""
    cells = F.sum("total_rows")
    return null_counts(df).agg(
        F.max("total_rows").alias("total_rows"),
        F.sum("null_count").alias("total_null_cells"),
        cells.alias("total_cells"),
        (F.try_divide(F.sum("null_count"), cells) * 100).alias("global_null_percentage"),
    )


def nulls_by(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(column, key, null_count) for keys with at least one null."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("null_count"))
                for c in columns
            ]
        ).alias("rows")
    )
    return counts.select(key, F.inline("rows")).where(F.col("null_count") > 0).select("column", key, "null_count")


def plain(df: DataFrame, column: str) -> Column:
    """The column's values; those with the same text are the same."""
    return F.col(column) + F.lit(0.0) if dict(df.dtypes)[column] in ("double", "float") else F.col(column)  # -0.0 is 0.0


def shown(df: DataFrame, column: str) -> Column:
    """The column's values as text."""
    return plain(df, column).cast("string")


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value, n) with null counted as a value. Values are shown as text."""
    pairs = [F.struct(F.lit(c).alias("column"), shown(df, c).alias("value")) for c in columns or df.columns]
    return df.select(F.inline(F.array(*pairs))).groupBy("column", "value").agg(F.count("*").alias("n"))


def value_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Value counts with their share of the column, most frequent first."""
    rows = df.agg(F.count("*")).scalar()  # every row has one value, null included, in each column
    return (
        value_counts(df, columns)
        .withColumn("pct", F.col("n") / rows * 100)
        .orderBy("column", F.desc("n"), "value")
    )


def cardinalities(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, cardinality, top_share): distinct values and share of the commonest, null included.

    Counted as ``value_counts`` does, but numbers stay numbers: their texts would take most of the time.
    """
    columns, kinds = list(columns or df.columns), dict(df.dtypes)
    exact = ("tinyint", "smallint", "int", "float", "double")

    def value(i: int, c: str) -> Column:
        number, text = (plain(df, c), F.lit(None)) if kinds[c] in exact else (F.lit(None), shown(df, c))
        return F.struct(F.lit(i).alias("nth"), number.cast("double").alias("number"), text.cast("string").alias("text"))

    values = df.select(F.inline(F.array(*(value(i, c) for i, c in enumerate(columns)))))
    counts = values.groupBy("nth", "number", "text").agg(F.count("*").alias("n"))
    per_column = counts.groupBy("nth").agg(F.count("*").alias("cardinality"), (F.max("n") / F.sum("n")).alias("top_share"))
    return per_column.select(F.array(*map(F.lit, columns))[F.col("nth")].alias("column"), "cardinality", "top_share")


def constant_columns(df: DataFrame) -> DataFrame:
    """Columns with one value, or with nulls alone: smallest and largest value and number of nulls, in one aggregation."""
    rows = F.count("*")
    per_column = []
    for c in df.columns:
        low, high, known = F.min(shown(df, c)), F.max(shown(df, c)), F.count(c)
        one = (known == 0) | ((known == rows) & (low == high))
        per_column.append(F.struct(F.lit(c).alias("column"), (one & (rows > 0)).alias("constant")))
    return df.agg(F.array(*per_column).alias("rows")).select(F.inline("rows")).where("constant").select("column")


def _mark(value: Column) -> Column:
    """52 bits of a value, null included: whole numbers that a double holds exactly."""
    return F.shiftrightunsigned(F.xxhash64(value), 12)


def majority_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, rows, held): per column the number of rows that hold the one value which a majority can have.

    A value with more than 0.51 of the rows is the median of the column in any order, and stays the median of a sketch with a
    rank error of 0.01. So the sketched median of the values' marks is the only candidate. It is a mergeable state of
    bounded size: one aggregation finds the candidates of all columns, a second one counts them exactly. Nothing is
    shuffled but one row for each task. For columns without such a majority ``held`` counts some value or other.
    """
    columns = list(columns or df.columns)
    marks = {c: _mark(plain(df, c)) for c in columns}
    found = df.agg(*(F.percentile_approx(marks[c], 0.5, 100).alias(f"m{i}") for i, c in enumerate(columns))).first()
    per_column = []
    for i, c in enumerate(columns):
        hit = marks[c] == F.lit(found[i])
        low, high = (f(F.when(hit, shown(df, c))) for f in (F.min, F.max))
        held, known = F.count_if(hit), F.count_if(hit & F.col(c).isNotNull())
        mixed = (known > 0) & ((known < held) | (low != high))
        per_column.append(F.struct(F.lit(c).alias("column"), F.count("*").alias("rows"), held.alias("held"), mixed.alias("mixed")))
    counts = df.agg(F.array(*per_column).alias("rows")).select(F.inline("rows"))
    mixed = [r["column"] for r in counts.where("mixed").collect()]  # two values with the same mark: at most ``columns`` names
    counts = counts.drop("mixed")
    for c in mixed:
        own = value_counts(df.where(marks[c] == F.lit(found[columns.index(c)])), [c]).agg(F.max("n")).scalar()
        counts = counts.withColumn("held", F.when(F.col("column") == c, own).otherwise(F.col("held")))
    return counts


def near_constant_columns(df: DataFrame, share: float = 0.99) -> DataFrame:
    """Columns of which one value, null included, has more than ``share`` of the rows."""
    if share < 0.51:
        raise ValueError("a majority is looked for: the share must be 0.51 or more")
    counts = majority_values(df).where(F.col("rows") > 0).withColumn("top_share", F.col("held") / F.col("rows"))
    return counts.where(F.col("top_share") > share).select("column", "top_share")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Exact duplicates: rows beyond the first of each distinct row."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"))


def head_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First rows in an explicit order."""
    return df.orderBy(*order).limit(n)


def tail_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """Last rows in an explicit order."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def cardinality_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, type, n_unique, cardinality_pct): distinct values without null, relative to rows."""
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    known = F.col("value").isNotNull()
    return (
        value_counts(df, columns)
        .groupBy("column")
        .agg(F.count_if(known).alias("n_unique"), F.sum("n").alias("rows"))
        .select(
            "column",
            types[F.col("column")].alias("type"),
            "n_unique",
            (F.col("n_unique") / F.col("rows") * 100).alias("cardinality_pct"),
        )
    )


def categorical_describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, unique, top, freq) over non-null values; ties go to the smallest value."""
    counts = value_counts(df, columns).where(F.col("value").isNotNull())
    best = F.min(F.struct((-F.col("n")).alias("rank"), "value"))
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"), F.count("*").alias("unique"), best["value"].alias("top"), F.max("n").alias("freq")
    )


def whitespace_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, padded, empty): strings with outer whitespace, strings empty after trimming."""
    texts = columns or [c for c, t in df.dtypes if t == "string"]

    def row(c: str):
        bare = F.regexp_replace(F.col(c), r"^\s+|\s+$", "")
        return F.struct(
            F.lit(c).alias("column"),
            F.count_if(bare != F.col(c)).alias("padded"),
            F.count_if(bare == "").alias("empty"),
        )

    return df.agg(F.array(*[row(c) for c in texts]).alias("rows")).select(F.inline("rows"))


def numeric_describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, mean, std, min, max, range, skewness, kurtosis) over non-null values.

    Rows of (column, value) share one set of aggregates. A set for each column makes a method that the JVM no longer compiles.
    """
    v = F.col("value")
    return long_values(df, columns).groupBy("column").agg(
        F.count(v).alias("count"),
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        (F.max(v) - F.min(v)).alias("range"),
        sample_skewness(v).alias("skewness"),
        sample_kurtosis(v).alias("kurtosis"),
    )


def extended_describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numeric description with exact quartiles, median and interquartile range."""
    quartiles = quantile_columns(df, columns, {"p25": 0.25, "median": 0.5, "p75": 0.75}).drop("n")
    return (
        numeric_describe(df, columns)
        .join(quartiles, "column")
        .withColumn("iqr", F.col("p75") - F.col("p25"))
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 15) -> DataFrame:
    """(column, bin, lower, upper, n) with equal-width bins; the maximum falls in the last bin.

    A constant column gets one bin.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    values = df.select(F.inline(pairs)).where(F.col("value").isNotNull())
    edges = values.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    bounds = edges.select("column", F.struct("lo", "hi").alias("b"))
    width = (F.col("b.hi") - F.col("b.lo")) / bins
    raw = F.floor((F.col("value") - F.col("b.lo")) / F.nullif(width, F.lit(0.0))).cast("int")
    spot = F.least(F.coalesce(raw, F.lit(0)), F.lit(bins - 1))
    lower = F.col("b.lo") + F.col("bin") * width
    return (
        with_lookup(values, bounds, ["column"])
        .groupBy("column", "b", spot.alias("bin"))
        .agg(F.count("*").alias("n"))
        .select("column", "bin", lower.alias("lower"), (lower + width).alias("upper"), "n")
    )
