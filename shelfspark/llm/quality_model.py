"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed words.

P(grade >= k) is a logistic function of one shared score less the k-th threshold. The score of a text is the mean weight
of its words, of their shapes and of words that repeat the one before, so long texts need no more memory than short
ones, and one weight more if the text bears a sign. One toxic word hardly moves a mean, so its presence is a feature of its own: signs are the words and
stems that mark toxic rows among the rows of quality. Rows are selected by the tail probability of the best grade.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfspark.llm.batches import given_back, per_text, slices, whole
from shelfspark.llm.frames import named
from shelfspark.session import settle

WEIGHTS = 1 << 17
#: Labelled rows that the fit sees, at most: those whose key has the smallest MD5 digest.
SAMPLE = 6000
#: UTF-8 bytes of their texts, at most: rows that begin beyond it, in the order of the digests, are not read.
SAMPLE_BYTES = 128 << 20
STEPS, RATE, SHRINK = 400, 0.1, 1e-4
#: Frequencies of words are small numbers; this brings the weights near one.
SCALE = 30.0
#: A sign is taken if the toxic rows it marks outweigh the others this many times, and are half of all at least after so many
#: rows of the mean are added.
OUTWEIGH, ADDED = 3, 2.0
#: Behind the weights of words and shapes stand that of bearing a sign, and that of words that repeat the one before them.
SIGN, REPEAT = WEIGHTS, WEIGHTS + 1
#: Bytes of text that are read at a time.
READ_BYTES = 1 << 20
#: First letters of a word that are a sign beside the whole word, for inflected words.
STEM = 4
_LETTERS = re.compile(r"[^\W\d_]+")
_SHAPES = ((re.compile(r"[^\W\d_]*[a-zß-ÿ][^\W\d_]*"), "a"), (re.compile(r"[^\W\d_a]+"), "A"), (re.compile(r"\d+"), "0"))


def _shape(word: str) -> str:
    for runs, mark in _SHAPES:
        word = runs.sub(mark, word)
    return word


def _slots(words: list[str]) -> np.ndarray:
    """Two weights for each word: its own and its shape's. The shape keeps marks, digits and capitals."""
    both = np.array([*(w.lower() for w in words), *("\x00" + _shape(w) for w in words)], dtype=object)
    hashed = pd.util.hash_array(both, categorize=False) if len(both) else np.zeros(0, np.uint64)
    return (hashed % np.uint64(WEIGHTS)).astype(np.int64).reshape(2, -1)


def _signs(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Two signs for each run of letters: the run and its stem. Second, the index of the word that holds the run."""
    runs = [_LETTERS.findall(w.lower()) for w in words]
    flat = [r for found in runs for r in found]
    both = np.array([*flat, *(r[:STEM] + "*" for r in flat)], dtype=object)
    hashed = pd.util.hash_array(both, categorize=False) if len(both) else np.zeros(0, np.uint64)
    return hashed.view(np.int64).reshape(2, -1), np.repeat(np.arange(len(words)), [len(r) for r in runs])


def _words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, index of each word, offsets of the texts."""
    parts = pc.split_pattern_regex(whole(texts), r"\s+")
    offsets = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    names, index = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
    filled = np.array([bool(n) for n in names], bool)[index]
    running = np.concatenate(([0], np.cumsum(filled)))
    return names, index[filled], running[offsets - offsets[0]]


def _repeats(index: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Is each word the same as the one before it in its text."""
    same = np.zeros(len(index), bool)
    same[1:] = index[1:] == index[:-1]
    same[offsets[:-1][np.diff(offsets) > 0]] = False
    return same


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than there are grades
    signs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def scores(self, texts: pa.Array) -> np.ndarray:
        names, index, offsets = _words(texts)
        signs, owner = _signs(names)
        marked = np.zeros(len(names))
        marked[owner[np.isin(signs, self.signs).any(axis=0)]] = 1
        value = self.weights[_slots(names)].sum(axis=0, dtype=float)[index] + self.weights[REPEAT] * _repeats(index, offsets)
        mean = SCALE * per_text(value, offsets) / np.maximum(1, np.diff(offsets))
        return mean + self.weights[SIGN] * (per_text(marked[index], offsets) > 0)

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        return _logistic(scores[:, None] - self.thresholds[None, :])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(owner: np.ndarray, slot: np.ndarray, value: np.ndarray, grades: np.ndarray, count: int) -> Model:
    """Maximum likelihood by Adam steps. ``owner``, ``slot`` and ``value`` are the entries of the rows' features."""
    weights = np.zeros(WEIGHTS + 2)
    share = np.array([(grades >= k).mean() for k in range(1, count)])
    share = np.clip(share, 1e-3, 1 - 1e-3)
    # Thresholds are the first one and the logarithms of the gaps, so they stay in order.
    start = -np.log(share / (1 - share))
    cut = np.concatenate((start[:1], np.log(np.maximum(np.diff(start), 1e-2))))
    used = np.unique(slot)
    at = np.searchsorted(used, slot)
    own = np.zeros(len(used))
    state = [np.zeros(len(used) + len(cut)) for _ in range(2)]
    rows = len(grades)
    each = np.arange(rows)
    for step in range(1, STEPS + 1):
        theta = np.cumsum(np.concatenate((cut[:1], np.exp(cut[1:]))))
        score = np.bincount(owner, weights=own[at] * value, minlength=rows)
        tails = np.concatenate((np.ones((rows, 1)), _logistic(score[:, None] - theta), np.zeros((rows, 1))), axis=1)
        slope = tails * (1 - tails)
        high, low = tails[each, grades], tails[each, grades + 1]
        chance = np.maximum(high - low, 1e-12)
        by_score = -(slope[each, grades] - slope[each, grades + 1]) / chance / rows
        by_theta = np.zeros(count + 1)
        np.add.at(by_theta, grades, slope[each, grades] / chance / rows)
        np.add.at(by_theta, grades + 1, -slope[each, grades + 1] / chance / rows)
        by_theta = by_theta[1:count]
        later = np.cumsum(by_theta[::-1])[::-1]
        by_cut = np.concatenate((later[:1], later[1:] * np.exp(cut[1:])))
        by_own = np.bincount(at, weights=by_score[owner] * value, minlength=len(used)) + SHRINK * own
        slopes = np.concatenate((by_own, by_cut))
        state[0] = 0.9 * state[0] + 0.1 * slopes
        state[1] = 0.999 * state[1] + 0.001 * slopes**2
        move = RATE * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-8)
        own -= move[: len(used)]
        cut = cut - move[len(used) :]
    weights[used] = own
    return Model(weights.astype(np.float32), np.cumsum(np.concatenate((cut[:1], np.exp(cut[1:])))))


def fit_signs(owner: np.ndarray, sign: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Signs of the toxic rows, best first; each is judged on the rows that those before it do not mark. ``owner`` and ``sign``
    are the entries of the rows' signs, one of a kind in a row, sorted by row."""
    names, at = np.unique(sign, return_inverse=True)
    ends = np.searchsorted(owner, np.arange(len(toxic) + 1))
    order = np.argsort(at, kind="stable")
    bounds = np.searchsorted(at[order], np.arange(len(names) + 1))
    marked, hits = (np.bincount(at, weights=w, minlength=len(names)) for w in (None, toxic[owner].astype(float)))
    live = np.ones(len(toxic), bool)
    found = []
    while toxic[live].any() and len(names):
        share = (hits + ADDED * toxic.mean()) / (marked + ADDED)
        gain = np.where(share >= 0.5, hits - OUTWEIGH * (marked - hits), 0)
        best = int(gain.argmax())
        if gain[best] <= 0:
            break
        found.append(names[best])
        rows = owner[order[bounds[best] : bounds[best + 1]]]
        rows = rows[live[rows]]
        live[rows] = False
        for row in rows:
            own = at[ends[row] : ends[row + 1]]
            marked[own] -= 1
            hits[own] -= toxic[row]
    return np.array(found, np.int64)


def grades(labels: DataFrame, key: str = "doc_id", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """``key`` and ``grade``: 0 poor, 1 of quality but toxic, 2 of quality. Rows without key or quality rate nothing; a missing
    toxic mark counts as not toxic; of several ratings of a key the lowest holds."""
    grade = F.when(named(quality) < 1, 0).when(F.coalesce(named(toxic), F.lit(0)) > 0, 1).otherwise(2)
    rated = labels.filter(named(key).isNotNull() & named(quality).isNotNull())
    return rated.select(named(key).cast("bigint").alias(key), grade.alias("grade")).groupBy(key).agg(F.min("grade").alias("grade"))


def fit(
    docs: DataFrame,
    rated: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
    count: int = 3,
    sample_bytes: int = SAMPLE_BYTES,
) -> Model:
    """Model from ``rated`` (``key``, ``grade`` from 0 to ``count`` - 1), of which ``sample`` rows and about ``sample_bytes`` of
    text are read at most, one row for each key. Only the features of that sample come to the driver. Null texts have no
    words. Without ratings half of the chance is the best grade's and the rest is spread evenly, so nothing is rejected."""
    # The number of rows is bounded, so they can be sent to every executor.
    few = rated.orderBy(F.md5(named(key).cast("string")), key).limit(sample)
    few = few.select(named(key).alias("key"), F.col("grade").cast("int").alias("grade"))
    rows = docs.select(named(key).cast("bigint").alias("key"), named(text).alias("text")).join(F.broadcast(few), "key")
    # A key may repeat over many rows; one of them is read, whatever the order of rows.
    rows = rows.groupBy("key", "grade").agg(F.min_by("text", F.md5(F.coalesce("text", F.lit("")))).alias("text"))
    rows = settle(rows, "rated")
    # At most ``sample`` rows without their texts.
    before = Window.partitionBy(F.lit(0)).orderBy(F.md5(F.col("key").cast("string")), "key").rowsBetween(Window.unboundedPreceding, -1)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    begun = rows.select("key", size.alias("size")).select("key", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("begun"))
    rows = rows.join(F.broadcast(begun.filter(F.col("begun") < sample_bytes).select("key")), "key")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given_back(slices(batches, "text", READ_BYTES)):
            names, index, offsets = _words(batch.column("text"))
            slots = _slots(names)
            hashed, holder = _signs(names)
            first = np.searchsorted(holder, np.arange(len(names) + 1))
            found, values, signs = [], [], []
            repeats = _repeats(index, offsets)
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                slot, times = np.unique(slots[:, index[a:b]], return_counts=True)
                found.append(np.append(slot, REPEAT).astype(np.int32))
                values.append((np.append(times, repeats[a:b].sum()) / max(1, b - a)).astype(np.float32))
                own = [hashed[:, first[w] : first[w + 1]].ravel() for w in np.unique(index[a:b])]
                signs.append(np.unique(np.concatenate([np.zeros(0, np.int64), *own])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("grade"),
                    pa.array([x.tobytes() for x in found], pa.binary()),
                    pa.array([x.tobytes() for x in values], pa.binary()),
                    pa.array([x.tobytes() for x in signs], pa.binary()),
                ],
                names=["key", "grade", "slots", "shares", "signs"],
            )

    read = rows.mapInArrow(features, "key bigint, grade int, slots binary, shares binary, signs binary").collect()
    read.sort(key=lambda r: (r.key, r.grade, bytes(r.slots)))
    if not read:
        even = 1 - np.arange(1, count) / (2 * (count - 1))
        return Model(np.zeros(WEIGHTS + 2, np.float32), -np.log(even / (1 - even)))
    rated_as = np.array([r.grade for r in read])
    signs, marked = _sign_features([np.frombuffer(r.signs, np.int64) for r in read], rated_as, count)
    slot = [np.frombuffer(r.slots, np.int32) for r in read]
    owner = np.concatenate((np.repeat(np.arange(len(read), dtype=np.int32), [len(s) for s in slot]), marked))
    value = SCALE * np.concatenate([np.frombuffer(r.shares, np.float32) for r in read])
    value = np.concatenate((value, np.ones(len(marked)))).astype(np.float32)
    slot = np.concatenate((*slot, np.full(len(marked), SIGN, np.int32)))
    del read
    return replace(fit_ordinal(owner, slot, value, rated_as, count), signs=signs)


def _sign_features(signs: list[np.ndarray], rated_as: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The signs that tell the best grade from those between it and 0, and the rows that bear one."""
    good = np.flatnonzero(rated_as > 0)
    if not len(good):
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    owner = np.repeat(np.arange(len(good)), [len(signs[i]) for i in good])
    found = fit_signs(owner, np.concatenate([signs[i] for i in good]), rated_as[good] < count - 1)
    return found, np.array([i for i, own in enumerate(signs) if np.isin(own, found).any()], np.int32)


def grade_documents(
    docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", least: float = 0.5, grade: int | None = None
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``row`` (position in the scan), ``expected_grade``, ``tail_probability``
    (of ``grade`` or better; default: the best one) and ``kept`` (that probability is ``least`` or more).

    A text without words, null or empty, is rated by the thresholds alone. Rows that repeat are rated alike. Very long texts
    are read whole, one at a time. An empty table gives no rows; other columns do not matter.
    """

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given_back(slices(batches, "text", READ_BYTES)):
            tails = model.tails(model.scores(batch.column("text")))
            chance = tails[:, -1 if grade is None else grade - 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("row"), pa.array(tails.sum(axis=1)), pa.array(chance), pa.array(chance >= least)],
                names=["key", "row", "expected_grade", "tail_probability", "kept"],
            )

    rows = docs.select(named(key).cast("bigint").alias("key"), F.monotonically_increasing_id().alias("row"), named(text).alias("text"))
    return rows.mapInArrow(rate, "key bigint, row bigint, expected_grade double, tail_probability double, kept boolean")


def accepted(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5, grade: int | None = None) -> DataFrame:
    """The rows of ``docs`` that ``grade_documents`` keeps, with all their columns, whatever these are called. Null and empty
    texts are rated by the thresholds alone, rows that repeat alike; an empty table stays empty."""
    names = docs.columns
    kept = [f"c{i}" for i in range(len(names))]
    at = names.index(text)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given_back(slices(batches, kept[at], READ_BYTES)):
            chance = model.tails(model.scores(batch.column(at)))[:, -1 if grade is None else grade - 1]
            yield batch.filter(pa.array(chance >= least))

    plain = docs.toDF(*kept)
    return plain.mapInArrow(choose, plain.schema).toDF(*names)
