"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

A window is a run of item words. It cannot occur in a text without its rarest shingle, so that one shingle is the
necessary prefix of the window's set of shingles: texts meet windows on it alone. Length and position bounds follow
from where the shingle stood, and what is left is compared word for word through the shingles that cover the window.
Rarity is counted over the whole corpus. The texts are read once for their shingles: an occurrence of any benchmark shingle
is kept with its place, checked against the words themselves, and counts, prefix join and verification work on these rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfspark.llm.frames import fresh, named
from shelfspark.session import settle

WINDOW = 10
SHINGLE = 5
#: Shingles of the benchmark that are sent to every executor at most; beyond it both sides are shuffled.
BROADCAST_SHINGLES = 250_000
# Fixed value: what stands between words, once A-Z are small letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text, A-Z in small letters; none for null."""
    text = F.coalesce(text, F.lit(""))
    plain = F.length(text) == F.octet_length(text)
    small = F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(small, SEPARATORS, -1), "")


def _part(of: Column, start: Column, size: Column) -> Column:
    return F.slice(of, start + 1, size)


def _joined(of: Column) -> Column:
    return F.array_join(of, " ")


def item_windows(items: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """Per item and distinct window: ``item`` (as text, null as empty), ``content`` (words joined by spaces), ``length``."""
    found = items.select(F.coalesce(named(item).cast("string"), F.lit("")).alias("item"), words(named(text)).alias("w"))
    found = found.filter(F.size("w") > 0).withColumn("length", F.least(F.size("w"), F.lit(window)))
    found = found.select("item", "w", "length", F.explode(F.sequence(F.lit(0), F.size("w") - F.col("length"))).alias("start"))
    return found.select("item", _joined(_part(F.col("w"), F.col("start"), F.col("length"))).alias("content"), "length").distinct()


def _benchmark(items: DataFrame, item: str, text: str, window: int, shingle: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Windows of items (``item``, ``window``), the shingles of each distinct window (``window``, ``length``, ``offset``, ``size``,
    ``shingle``) and the distinct shingles (``shingle``, ``size``, ``content``, ``code``)."""
    held = settle(item_windows(items, item, text, window), "items")
    distinct = held.select("content", "length").distinct().withColumn("window", F.monotonically_increasing_id())
    distinct = settle(distinct, "windows")
    size = F.least("length", F.lit(shingle))
    cut = distinct.select("window", "length", size.alias("size"), F.split("content", " ").alias("w"))
    cut = cut.withColumn("offset", F.explode(F.sequence(F.lit(0), F.col("length") - F.col("size"))))
    cut = cut.select("window", "length", "offset", "size", _joined(_part(F.col("w"), F.col("offset"), F.col("size"))).alias("content"))
    shingles = cut.select("size", "content").distinct().withColumn("shingle", F.monotonically_increasing_id())
    shingles = settle(shingles.withColumn("code", F.xxhash64(F.split("content", " "))), "shingles")
    parts = settle(cut.join(shingles.select("size", "content", "shingle"), ["size", "content"]).drop("content"), "parts")
    return held.join(distinct, ["content", "length"]).select("item", "window"), parts, shingles


def _occurrences(docs: DataFrame, text: str, shingles: DataFrame, sizes: list[int], most: int) -> DataFrame:
    """Every place (``row``, ``at``, ``shingle``) where a text has a shingle of the benchmark, with the number of its words."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), words(named(text)).alias("w"))
    # Exploding a list of one makes the words a value that is there once for each text, not once for each use.
    rows = rows.select("row", F.explode(F.array("w")).alias("w"))
    rows = rows.select("row", "w", F.size("w").alias("n_words"), F.explode(F.array(*map(F.lit, sizes))).alias("size"))
    places = rows.select("row", "w", "n_words", "size", F.posexplode("w").alias("at", "word")).drop("word")
    places = places.filter(F.col("at") + F.col("size") <= F.col("n_words"))
    own = _part(F.col("w"), F.col("at"), F.col("size"))
    known = shingles.select(F.col("size").alias("known_size"), "content", "shingle", "code")
    if shingles.count() <= most:
        # The words are compared where the codes meet; as an equality they would be spelled out at every place.
        spelled = F.startswith(_joined(own), F.col("content")) & F.startswith(F.col("content"), _joined(own))
        same = (F.xxhash64(own) == F.col("code")) & spelled
        return places.join(F.broadcast(known), same).select("row", "n_words", "at", "shingle")
    spelled = places.select("row", "n_words", "at", "size", _joined(own).alias("content"))
    known = known.withColumnRenamed("known_size", "size").drop("code")
    return spelled.join(known, ["size", "content"]).select("row", "n_words", "at", "shingle")


def _prefixes(parts: DataFrame, seen: DataFrame) -> DataFrame:
    """Per window, all of whose shingles the corpus has, the rarest one: ``window``, ``length``, ``offset``, ``shingle``."""
    counts = seen.groupBy("shingle").agg(F.count("*").alias("n"))
    ranked = parts.join(counts, "shingle", "left")
    rarest = ranked.groupBy("window", "length").agg(
        F.min(F.struct("n", "shingle", "offset")).alias("p"), F.count_if(F.col("n").isNull()).alias("unseen")
    )
    return rarest.filter("unseen = 0").select("window", "length", "p.offset", "p.shingle")


def _cover(parts: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The shingles that cover a window without gaps, but for its prefix: one after the other, and the last one."""
    needed = (F.col("offset") % F.col("size") == 0) | (F.col("offset") == F.col("length") - F.col("size"))
    other = prefixes.select("window", F.col("offset").alias("prefix_offset"))
    return parts.filter(needed).join(other, "window").filter("offset <> prefix_offset").drop("prefix_offset")


def occurring_windows(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    most: int = BROADCAST_SHINGLES,
) -> tuple[DataFrame, DataFrame]:
    """The places of windows in texts (``row``: position in the scan, ``start``, ``length``, ``window``) and the windows of the
    items (``item``, ``window``)."""
    held, parts, shingles = _benchmark(items, item, item_text, window, shingle)
    sizes = [r["size"] for r in shingles.select("size").distinct().collect()]  # ``shingle`` values at most
    if not sizes:
        empty = "row bigint, start int, length int, window bigint"
        return docs.sparkSession.createDataFrame([], empty), held
    seen = settle(_occurrences(docs, text, shingles, sorted(sizes), most), "seen")
    prefixes = settle(_prefixes(parts, seen), "prefixes")
    met = seen.join(prefixes, "shingle").withColumn("start", F.col("at") - F.col("offset"))
    met = met.filter((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))
    met = settle(met.select("row", "start", "length", "window"), "met")
    cover = settle(_cover(parts, prefixes), "cover")
    needed = met.join(cover.select("window", "offset", "shingle"), "window")
    needed = needed.select("row", "start", "window", (F.col("start") + F.col("offset")).alias("at"), "shingle")
    failed = needed.join(seen.select("row", "at", "shingle"), ["row", "at", "shingle"], "left_anti")
    return met.join(failed.select("row", "start", "window").distinct(), ["row", "start", "window"], "left_anti"), held


def contamination(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    **options,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``row`` (position in the scan), ``n_words``, ``n_hit``, ``n_items`` and ``items``.

    A window is ``window`` consecutive words of an item, or all words of a shorter one. ``n_hit`` counts the words that stand
    inside an occurrence of some window, ``items`` are the ids of items with occurring windows, as sorted texts without
    repeats (``n_items`` of them); an item without an id is the empty text. Null and empty texts have no words, and an
    item without words has no window. Documents or items that repeat are rows as any others, equal ids one item. An
    empty benchmark hits nothing, an empty table gives no rows. Other columns are not read, whatever their names. One text
    with its words has to fit into the memory of a task. ``docs`` must be a table or another frame whose rows come in
    the same order each time; tables of occurrences are written while the frame is built.
    """
    found, held = occurring_windows(docs, items, text, item, item_text, **options)
    found = settle(found, "found")
    before = Window.partitionBy("row").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    covered = found.select("row", "start", "length").distinct().withColumn("until", F.max(end).over(before))
    added = F.greatest(F.lit(0), end - F.greatest("start", F.coalesce("until", F.lit(0))))
    hits = covered.groupBy("row").agg(F.sum(added).alias("n_hit"))
    of = found.select("row", "window").distinct().join(held, "window").select("row", "item").distinct()
    of = of.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    hits = settle(hits.join(of, "row"), "hits")
    none = F.array().cast("array<string>")
    rows = docs.select(
        named(key).alias("key"), F.monotonically_increasing_id().alias("row"), F.size(words(named(text))).cast("bigint").alias("n_words")
    )
    return rows.join(hits, "row", "left").select(
        "key",
        "row",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("bigint").alias("n_items"),
        F.coalesce("items", none).alias("items"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without an occurring window, with all their columns."""
    (row,) = fresh(docs, "row")
    lost = contamination(docs, items, key, text, **options).filter("n_hit > 0").select(F.col("row").alias(row))
    return docs.withColumn(row, F.monotonically_increasing_id()).join(lost.hint("merge"), row, "left_anti").drop(row)
