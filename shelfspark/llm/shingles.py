"""Weighted shingles of words, ProbMinHash signatures and the probability Jaccard similarity, in NumPy."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from shelfspark.llm.batches import whole

# Odd multipliers of the usual 64-bit mixers.
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers with every bit spread over all."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts, and the offsets of the texts. Words are runs of letters, digits and underscores
    in lower case."""
    parts = pc.split_pattern_regex(pc.utf8_lower(whole(texts)), r"[^\pL\pM\pN_]+")
    offsets = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    own = pd.util.hash_array(np.array(words, dtype=object), categorize=False) if words else np.zeros(0, np.uint64)
    index = coded.indices.to_numpy()
    filled = np.array([bool(w) for w in words], bool)[index]
    running = np.concatenate(([0], np.cumsum(filled)))
    return own[index[filled]], running[offsets - offsets[0]]


def shingles(texts: pa.Array, words: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Per text its distinct shingles in ascending order: hashes, counts, offsets of the texts, and a digest of the sequence
    of words. A text of fewer words, but one, is a single shingle; a text without words has none."""
    hashes, offsets = word_hashes(texts)
    size = np.diff(offsets)
    digests = [hashlib.sha256(hashes[a:b].tobytes()).digest()[:16] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    owner = np.repeat(np.arange(len(size)), size)
    left = offsets[1:][owner] - np.arange(len(hashes))  # words from here to the end of the text
    rolled = np.zeros(len(hashes), np.uint64)
    for k in range(words):
        shifted = np.zeros(len(hashes), np.uint64)
        shifted[: len(hashes) - k] = hashes[k:]
        rolled = rolled * _A + np.where(left > k, shifted, np.uint64(0))
    first = np.zeros(len(hashes), bool)
    first[offsets[:-1][size > 0]] = True
    own = (left >= words) | first
    owner, rolled = owner[own], mixed(rolled[own])
    order = np.lexsort((rolled, owner))
    owner, rolled = owner[order], rolled[order]
    new = np.ones(len(rolled), bool)
    new[1:] = (rolled[1:] != rolled[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(rolled)))
    ends = np.searchsorted(owner[at], np.arange(len(size)), side="right")
    return rolled[at], counts, np.concatenate(([0], ends)), digests


def weights(counts: np.ndarray) -> np.ndarray:
    """1 + log2 of the counts: a phrase that a text repeats hundreds of times must not make up most of it."""
    return 1 + np.log2(counts)


def signatures(hashes: np.ndarray, weights: np.ndarray, offsets: np.ndarray, registers: int) -> np.ndarray:
    """ProbMinHash: in each register the element that arrived there first, 0 for texts without elements.

    Each element arrives again and again, at times of a Poisson process with its weight as rate, each time in a random
    register. It is followed while it can still be first somewhere: until its time passes the latest first arrival
    of its text. Two registers are equal with the probability Jaccard similarity as probability.
    """
    texts = len(offsets) - 1
    owner = np.repeat(np.arange(texts), np.diff(offsets))
    first = np.full(texts * registers, np.inf)
    holder = np.zeros(texts * registers, np.uint64)
    element, weight, time = hashes, weights.astype(float), np.zeros(len(hashes))
    turn = 0
    while len(element):
        turn += 2
        wait, place = (np.uint64(t * int(_A) % (1 << 64)) for t in (turn, turn + 1))
        waits = mixed(element + wait)
        time = time - np.log(((waits >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)) / weight
        spot = owner * registers + (mixed(element + place) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, spot, time)
        won = first[spot] == time
        holder[spot[won]] = element[won]
        alive = time < first.reshape(texts, registers).max(axis=1)[owner]
        owner, element, weight, time = owner[alive], element[alive], weight[alive], time[alive]
    return holder.reshape(texts, registers)


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One number for each band of registers, which also depends on the band."""
    parts = signature.reshape(len(signature), bands, -1)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _C, parts.shape[:2]).copy()
    for k in range(parts.shape[2]):
        out = mixed(out * _A + parts[:, :, k])
    return out.view(np.int64)


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Exact similarity of two weighted sets with distinct, ascending elements: the sum over common elements d of
    1 / sum over all e of max(a_e / a_d, b_e / b_d). With equal weights it is the Jaccard similarity."""
    common, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    wa, wb = wa.astype(float), wb.astype(float)
    # max(a_e, b_e * rho) for the ratio rho of d: only common elements can go either way.
    only_a = wa.sum() - wa[i].sum()
    only_b = wb.sum() - wb[j].sum()
    ratio, at, times = np.unique(wa[i] / wb[j], return_inverse=True, return_counts=True)
    sums_a = np.bincount(at, weights=wa[i])
    sums_b = np.bincount(at, weights=wb[j])
    above = np.cumsum(sums_a[::-1])[::-1]
    below = np.concatenate(([0.0], np.cumsum(sums_b)[:-1]))
    whole_sum = only_a + above + ratio * (only_b + below)
    return float((sums_a / whole_sum).sum()) if times.size else 0.0
