"""Groups of spelling variants by pivotal grams.

Two words are near if one inserted, deleted or replaced character makes them equal. The bigrams of all words are ordered
by rarity. A word's prefix are its three rarest bigrams (with all places of these), its pivots two disjoint ones of the
prefix, rarest in sum, chosen by dynamic programming. One edit can spoil one pivot only. Of two near words the one whose prefix
ends earlier in the order of rarity therefore has a pivot that the other word has in its prefix: the left pivot, if the
edit comes behind it, or else the right one, with the edit in front of it. So pivots are looked up among prefixes with
limits on their position: the same place from the untouched end of the word, with the same characters up to there, and lengths
that differ by one at most. Of the rest, either the first or the last half is untouched; what remains is verified.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.frames import named
from shelfspark.session import settle

RUN = "[A-Za-z\\u00C0-\\u00FF]"
LEAST_CHARS = 7
LEAST_COUNT = 2
#: A form is so many times as frequent as its variant at least.
RATIO = 10
#: One of so many occurrences loses a character, so that the corpus holds misspellings.
SPOILED = 31
GRAM = 2
#: One edit spoils two bigrams at most: three of a word's bigrams are enough for its prefix.
PREFIX = GRAM + 1
#: Bigrams over 26 small letters, 26 capitals and the 64 characters from U+00C0 on: no vocabulary has more.
MOST_GRAMS = (26 + 26 + 64) ** GRAM


def small_letters(text: Column) -> Column:
    """A-Z in small letters, other characters as they are."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def spoiled(run: Column, key: Column, one_in: int) -> Column:
    """The run, or for one of ``one_in`` keys and runs the run without one of its characters."""
    h = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run))
    at = F.pmod(h, F.length(run)).cast("int")
    short = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(F.pmod(h, F.lit(one_in)) == 0, short).otherwise(run)


def vocabulary(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_chars: int = LEAST_CHARS,
    least_count: int = LEAST_COUNT,
    one_in: int = SPOILED,
) -> DataFrame:
    """The distinct words of all texts (``word``, ``n``), with ``least_chars`` characters and ``least_count`` occurrences or more."""
    # Shorter runs cannot give such words; the pattern passes them by.
    runs = F.regexp_extract_all(small_letters(F.coalesce(named(text), F.lit(""))), F.lit(f"{RUN}{{{least_chars},}}"), F.lit(0))
    rows = docs.select(named(key).alias("key"), F.explode(runs).alias("run"))
    words = rows.select(spoiled(F.col("run"), F.col("key"), one_in).alias("word")).filter(F.length("word") >= least_chars)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def grams(word: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(word) - (GRAM - 1)), lambda i: F.substring(word, i, F.lit(GRAM)))


def gram_counts(words: DataFrame) -> list[tuple[str, int]]:
    """Bigrams of the distinct words with the number of their places, the rarest first. At most MOST_GRAMS come to the driver."""
    counts = words.select(F.explode(grams(F.col("word"))).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    found = counts.orderBy("n", "gram").limit(MOST_GRAMS + 1).collect()
    if len(found) > MOST_GRAMS:
        raise ValueError(f"more than {MOST_GRAMS} bigrams: words hold characters beyond the pattern")
    return [(r["gram"], r["n"]) for r in found]


def signature(word: str, rank: dict[str, int], frequency: list[int]) -> tuple[int, int, int, list[int]]:
    """Places of the two pivots, the rank at which the prefix ends, and the places of the prefix, from 0."""
    own = [rank[word[i : i + GRAM]] for i in range(len(word) - GRAM + 1)]
    last = sorted(own)[PREFIX - 1]
    places = [i for i, r in enumerate(own) if r <= last]
    # Rarest pivot that ends before each place, then the rarest pair that ends at it.
    best: tuple[int, int, int] | None = None
    left, waiting = None, 0
    for j in places:
        while waiting < len(places) and places[waiting] + GRAM <= j:
            cost = frequency[own[places[waiting]]]
            if left is None or cost < left[0]:
                left = (cost, places[waiting])
            waiting += 1
        if left is not None and (best is None or left[0] + frequency[own[j]] < best[0]):
            best = (left[0] + frequency[own[j]], left[1], j)
    assert best is not None  # of three places two are disjoint
    return best[1], best[2], last, places


def signed_words(words: DataFrame) -> DataFrame:
    """``words`` (``word``, ``n``) with the places of their pivots (``left``, ``right``) and prefixes (``places``), and ``last``."""
    counts = gram_counts(words)
    ranks, frequency = {gram: i for i, (gram, _) in enumerate(counts)}, [n for _, n in counts]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right, last, places = [], [], [], []
            for word in batch.column("word").to_pylist():
                a, b, end, own = signature(word, ranks, frequency)
                left.append(a)
                right.append(b)
                last.append(end)
                places.append(own)
            columns = [batch.column("word"), batch.column("n"), *(pa.array(x, pa.int32()) for x in (left, right, last))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(places, pa.list_(pa.int32()))], names=["word", "n", "left", "right", "last", "places"]
            )

    return words.select("word", "n").mapInArrow(sign, "word string, n bigint, left int, right int, last int, places array<int>")


def _context(side: Column, at: Column) -> tuple[Column, Column]:
    """The characters from the untouched end of the word (0: its start) through the gram at place ``at``, and the others."""
    word = F.col("word")
    front = side == 0
    size = F.length(word)
    held = F.when(front, F.substring(word, F.lit(1), at + GRAM)).otherwise(F.substring(word, at + 1, size))
    rest = F.when(front, F.substring(word, at + GRAM + 1, size)).otherwise(F.substring(word, F.lit(1), at))
    return held, rest


def _halves(rest: Column, least: Column) -> tuple[Column, Column]:
    """Hashes of the first and the last half, for two words of which the shorter one has ``least`` characters there."""
    half = F.floor(F.greatest(least, F.lit(0)) / 2).cast("int")
    return F.hash(F.substring(rest, F.lit(1), half)), F.hash(F.substring(rest, F.length(rest) - half + 1, half))


def near_pairs(signed: DataFrame) -> DataFrame:
    """Pairs of near words, each one or more times, in either order: ``word``, ``n``, ``other``, ``other_n``."""
    sides = [(side, place, more) for side, place in ((0, "left"), (1, "right")) for more in (-1, 0, 1)]
    looks = F.array(
        *(F.struct(F.lit(s).alias("side"), F.col(p).alias("at"), F.lit(m).alias("more")) for s, p, m in sides)
    )
    pivots = signed.select("word", "n", "last", F.inline(looks))
    held, rest = _context(F.col("side"), F.col("at"))
    first, final = _halves(rest, F.length(rest) + F.least("more", F.lit(0)))
    pivots = pivots.select(
        F.xxhash64("side", F.length("word") + F.col("more"), held).alias("code"), "word", "n", "last", "more", first.alias("first"), final.alias("final")
    )
    grams_held = signed.select("word", "n", "last", F.explode("places").alias("at"))
    grams_held = grams_held.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
    first, final = _halves(rest, F.length(rest))
    first_less, final_less = _halves(rest, F.length(rest) - 1)
    prefixes = grams_held.select(
        F.xxhash64("side", F.length("word"), held).alias("code"),
        F.col("word").alias("other"),
        F.col("n").alias("other_n"),
        F.col("last").alias("other_last"),
        first.alias("first_same"),
        final.alias("final_same"),
        first_less.alias("first_less"),
        final_less.alias("final_less"),
    )
    half = F.when(
        F.col("more") == 1, (F.col("first") == F.col("first_less")) | (F.col("final") == F.col("final_less"))
    ).otherwise((F.col("first") == F.col("first_same")) | (F.col("final") == F.col("final_same")))
    near = (F.col("last") <= F.col("other_last")) & half & (F.levenshtein("word", "other", 1) == 1)
    met = pivots.alias("p").join(prefixes.alias("q"), (F.col("p.code") == F.col("q.code")) & near)
    return met.select("word", "n", "other", "other_n")


def _followed(forms: DataFrame) -> DataFrame:
    """``word`` and the ``root`` that its forms lead to. Every form is RATIO times as frequent as its word, so a way has as many
    steps as the largest count has digits; each turn doubles the steps."""
    roots = forms.select("word", F.col("form").alias("root"))
    while True:
        beyond = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = settle(roots.join(beyond, "root", "left"), "roots")
        roots = jumped.select("word", F.coalesce("next", "root").alias("root"))
        if jumped.filter("next IS NOT NULL").isEmpty():
            return roots


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """One row per row of ``words`` (``word``, ``n``; distinct words): ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Near words differ by exactly one inserted, deleted or replaced character. The form is the near word of largest count,
    of several the smallest by code points, if its count is ``ratio`` times the word's or more, else null; the root is
    where the forms lead, the word itself if it has none. Words have three bigrams or more (four characters) of the
    alphabet that the module names. An empty table gives no rows. Intermediate tables are written while the frame is built.
    """
    pairs = settle(near_pairs(settle(signed_words(words), "signed")), "pairs")
    swapped = pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = pairs.unionByName(swapped).groupBy("word", "n").agg(F.count_distinct("other").alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= F.col("n") * ratio
    near = near.select(
        "word",
        "n_near",
        F.when(enough, F.col("best.other")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    near = settle(near, "near")
    roots = _followed(near.filter("form IS NOT NULL"))
    found = words.join(near, "word", "left").join(roots, "word", "left")
    return found.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n"
    )


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", ratio: int = RATIO, **options) -> DataFrame:
    """The spelling variants among the words of all texts, see ``vocabulary`` and ``variants``.

    Null and empty texts have no words. A null key enters the choice of spoiled occurrences as an empty text. Rows
    that repeat count as any others. Very long texts are read whole, but have to fit into a task with their runs. Other
    columns are not read, whatever their names.
    """
    return variants(settle(vocabulary(docs, key, text, **options), "words"), ratio)
