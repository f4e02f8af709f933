"""Statistics documents: long metric rows written as JSON and read back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

METRICS = T.StructType(
    [
        T.StructField("section", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("text", T.StringType()),
    ]
)


def flatten(df: DataFrame, section: str, prefix: str, keys: Sequence[str] = ()) -> DataFrame:
    """(section, path, value, text): one row per figure, path = prefix.keys.column.

    Numbers and booleans land in ``value``, dates and strings in ``text``.
    """
    textual = {c for c, t in df.dtypes if t in ("string", "date")}
    stem = F.concat_ws(".", F.lit(prefix), *[F.col(k).cast("string") for k in keys])
    cells = [
        F.struct(
            F.concat_ws(".", stem, F.lit(c)).alias("path"),
            (F.lit(None) if c in textual else F.col(c)).cast("double").alias("value"),
            (F.col(c) if c in textual else F.lit(None)).cast("string").alias("text"),
        )
        for c in df.columns
        if c not in keys
    ]
    return df.select(F.lit(section).alias("section"), F.inline(F.array(*cells)))


def write_metrics(metrics: DataFrame, path: str) -> str:
    """JSON lines, one folder per section."""
    metrics.write.mode("overwrite").partitionBy("section").json(path)
    return path


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS).json(path).select(*METRICS.fieldNames())


def read_draft(spark: SparkSession, path: str) -> DataFrame:
    """A draft text as rows (line)."""
    return spark.read.text(path).withColumnRenamed("value", "line")
