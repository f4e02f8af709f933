"""CSV scans of the three retail tables with explicit schemas: strict ones, and checked ones that keep bad lines apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark import contract as C


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


def read_retail(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Transactions, stores and calendar with typed dates."""
    return (
        read_table(spark, f"{folder}/transactions.csv", C.TRANSACTIONS),
        read_table(spark, f"{folder}/stores.csv", C.STORES),
        read_table(spark, f"{folder}/calendar.csv", C.CALENDAR),
    )


def with_text_dates(schema: T.StructType) -> T.StructType:
    """The same schema with its dates left as text."""
    return T.StructType(
        [
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DateType) else f.dataType)
            for f in schema
        ]
    )


def read_text_dates(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Scan that leaves dates as text; :func:`parse_dates` types them at the edge."""
    return read_table(spark, path, with_text_dates(schema))


def parse_dates(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.to_date(F.col(c), "yyyy-MM-dd") for c in columns or (C.DAY,)})


# Why a line is not taken.
UNREADABLE, NO_KEY, BAD_DATE = "unreadable", "no key", "bad date"
LINE, REASON = "_line", "_reason"


def read_checked(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, text_dates: bool = False) -> DataFrame:
    """Every line as a row of ``schema`` with LINE and REASON, which are null for lines that can be taken.

    A line is unreadable if a value does not fit its type or the number of values is not that of the columns; LINE has its
    text. A line without one of the columns that must not be null has no key; LINE then has its values. All columns are parsed
    whatever is selected afterwards, so that a line is good or bad for every query alike. ``text_dates`` leaves dates
    as text, for ``parse_checked``.
    """
    needed = [f.name for f in schema if not f.nullable]
    shape = with_text_dates(schema) if text_dates else schema
    loose = T.StructType([T.StructField(f.name, f.dataType) for f in shape])
    rows = (
        spark.read.schema(loose.add(LINE, T.StringType()))
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", LINE)
        .option("dateFormat", "yyyy-MM-dd")
        .csv(paths if isinstance(paths, str) else list(paths))
    )
    # An empty line has no key. Asking for it this way names every column: those that no query names are not parsed, and
    # lines that only they make unreadable would pass.
    keyless = sum((F.col(f.name).isNotNull().cast("int") for f in shape), F.lit(0)) == 0
    for c in needed:
        keyless = keyless | F.col(c).isNull()
    values = F.concat_ws(",", *(F.coalesce(F.col(f.name).cast("string"), F.lit("")) for f in loose if f.name != LINE))
    return rows.withColumn(REASON, F.when(F.col(LINE).isNotNull(), UNREADABLE).when(keyless, NO_KEY)).withColumn(
        LINE, F.when(F.col(REASON) == NO_KEY, values).otherwise(F.col(LINE))
    )


def parse_checked(rows: DataFrame, *columns: str) -> DataFrame:
    """Dates of a checked scan that are text so far as dates; a line with one that cannot be read is bad, LINE has the date."""
    for c in columns or (C.DAY,):
        day = F.try_to_date(F.col(c), "yyyy-MM-dd")
        lost = F.col(REASON).isNull() & F.col(c).isNotNull() & day.isNull()
        rows = rows.withColumns({LINE: F.when(lost, F.col(c)).otherwise(F.col(LINE)), REASON: F.when(lost, BAD_DATE).otherwise(F.col(REASON)), c: day})
    return rows


def taken(rows: DataFrame) -> DataFrame:
    """The good lines of a checked scan, in the columns of the table."""
    return rows.where(F.col(REASON).isNull()).drop(LINE, REASON)


def refused(rows: DataFrame) -> DataFrame:
    """(reason, line) of the bad ones."""
    return rows.where(F.col(REASON).isNotNull()).select(F.col(REASON).alias("reason"), F.col(LINE).alias("line"))
