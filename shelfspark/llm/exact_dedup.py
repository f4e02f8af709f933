"""Exact dedup by skew-safe combining: copies meet in their partition, then in salted digest groups, then the winners
of the salts meet. Every stage groups by the full content, beside its digest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.frames import fresh, named
from shelfspark.session import settle

SALTS = 64
#: Bits of a row's position below the number of its partition.
PARTITION_BITS = 33
# The characters that do not count.
BLANKS = " \t\n\v\f\r"


def normalised(text: Column) -> Column:
    """The text without blanks; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    for c in BLANKS:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def _combined(rows: DataFrame, salts: int) -> DataFrame:
    """Per digest and content the best row and the number of rows. The salt is the number of the row's partition, so the first
    aggregation leaves one row of a content in each partition before anything is moved; those meet by salt, then globally."""
    # Larger is better: longest, smallest key (null is smaller than any complement), first row.
    best = F.struct("size", F.bitwise_not("key").alias("low_key"), F.bitwise_not("row").alias("low_row"))
    salted = rows.groupBy("digest", "content", (F.shiftright("row", PARTITION_BITS) % salts).alias("salt"))
    merged = salted.agg(F.max(best).alias("best"), F.count("*").alias("n"))
    return merged.groupBy("digest", "content").agg(F.max("best").alias("best"), F.sum("n").alias("n"))


def copies(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``keep``, ``size`` (of the group), ``kept``, ``digest`` and ``row``.

    Of equal contents the row with the most characters stays, then the smallest key (null last), then the
    first row. Null texts equal empty ones; rows that repeat with their key are copies as any others, and one
    stays. ``digest`` may collide: contents are compared in full. ``key`` is a whole number.

    Two small tables are written while the frame is built: the digests of all rows, without texts, and the
    winners of groups of two and more. ``row`` is the position in the scan, so ``docs`` must be
    a table or another frame whose rows come in the same order each time.
    """
    content = normalised(named(text))
    rows = docs.select(
        named(key).cast("bigint").alias("key"),
        F.monotonically_increasing_id().alias("row"),
        F.length(F.coalesce(named(text), F.lit(""))).alias("size"),
        content.alias("content"),
    ).withColumn("digest", digest(F.col("content")))
    seen = settle(rows.select("key", "row", "digest"), "digests")
    winners = settle(
        _combined(rows, salts)
        .groupBy("digest")
        .agg(F.max("best").alias("best"), F.sum("n").alias("n"), F.count("*").alias("contents"))
        .filter("n > 1")
        .select("digest", F.bitwise_not("best.low_key").alias("keep"), F.bitwise_not("best.low_row").alias("first"), "n", "contents"),
        "winners",
    )
    collided = winners.filter("contents > 1").select("digest")
    if collided.isEmpty():
        return _decided(seen.join(winners, "digest", "left"))
    rows = rows.join(collided, "digest", "left_semi")
    each = _combined(rows, salts).select(
        "digest", "content", F.bitwise_not("best.low_key").alias("keep"), F.bitwise_not("best.low_row").alias("first"), "n"
    )
    apart = rows.select("key", "row", "digest", "content").join(each, ["digest", "content"])
    plain = seen.join(collided, "digest", "left_anti").join(winners, "digest", "left")
    return _decided(plain).unionByName(_decided(apart))


def _decided(found: DataFrame) -> DataFrame:
    alone = F.col("n").isNull()
    return found.select(
        "key",
        F.when(alone, F.col("key")).otherwise(F.col("keep")).alias("keep"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("size"),
        (alone | (F.col("row") == F.col("first"))).alias("kept"),
        "digest",
        "row",
    )


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    (row,) = fresh(docs, "row")
    lost = copies(docs, key, text).filter(~F.col("kept")).select(F.col("row").alias(row))
    return docs.withColumn(row, F.monotonically_increasing_id()).join(lost.hint("merge"), row, "left_anti").drop(row)
