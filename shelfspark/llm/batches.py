"""Arrow helpers for the text operators: bounded slices, and chunks of words with their dictionary."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Bytes of text that are worked on at a time; one longer text is a slice of its own.
SLICE_BYTES = 4 << 20

#: White space that every regular expression counts as such.
WHITE = b" \t\n\r"
# Bytes by what a cut looks at: 1 such white space, 2 ASCII letters and digits, 3 other ASCII characters that are no white space.
_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = 3
_KIND[list(WHITE)] = 1
_KIND[[b for b in range(128) if chr(b).isalnum()]] = 2


def whole(column: pa.Array) -> pa.Array:
    """Texts as large strings, null as empty."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text, however long single texts are."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.binary_length(whole(batch.column(text))).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    pa.default_memory_pool().release_unused()


def given_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; when the task ends, memory that its arrays have left free goes back to the system. Python workers serve
    one task after another, and the C library would keep it."""
    yield from batches
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def chunked(texts: pa.Array, uncut: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Cut every text before white space that follows another character, and between an ASCII letter or digit and ASCII
    punctuation.

    Returns the distinct chunks, the index of each chunk in order, and the offsets of the texts. No
    match of a word pattern that allows white space only in front, and keeps letters and digits apart from punctuation behind
    them, spans such a cut, so chunks can be encoded on their own. Texts that ``uncut`` marks are one chunk each.
    """
    ends = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    begins = np.zeros(len(data) + 1, bool)
    if len(data):
        kind = _KIND[data]
        white = kind == 1
        begins[1:-1] = (white[1:] & (kind[:-1] > 1)) | ((kind[:-1] == 2) & (kind[1:] == 3))
        wide = np.flatnonzero(white[1:] & (data[:-1] > 127)) + 1
        begins[wide[~white_before(data, wide)]] = True
    if uncut is not None:
        for i in np.flatnonzero(uncut).tolist():
            begins[ends[i] : ends[i + 1]] = False
    begins[ends] = True
    begins = np.flatnonzero(begins)
    parts = pa.LargeStringArray.from_buffers(len(begins) - 1, pa.py_buffer(begins), pa.py_buffer(data))
    coded = parts.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), np.searchsorted(begins, ends)


@lru_cache(maxsize=8)
def cuts_hold(pattern: str) -> bool:
    """Whether words by ``pattern`` never reach over a cut of ``chunked``, tried on all short rows of characters of each kind."""
    words = regex.compile(pattern).findall
    tried = ["".join(x) for n in range(1, 6) for x in product(" \na1'é", repeat=n)]
    names, index, offsets = chunked(pa.array(tried, pa.large_string()))
    cut = [words(x) for x in names.to_pylist()]
    pieces = [cut[i] for i in index.tolist()]
    return all(words(t) == list(chain.from_iterable(pieces[a:b])) for t, a, b in zip(tried, offsets, offsets[1:], strict=False))


def white_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether white space of two or three bytes ends at each place, or something that is written much like it."""
    a, b, c = data[at - 3], data[at - 2], data[at - 1]
    two = (b == 0xC2) & ((c == 0x85) | (c == 0xA0))
    spaces = (a == 0xE2) & (((b == 0x80) & ((c <= 0x8A) | (c >= 0xA8))) | (b == 0x81))
    return two | spaces | ((a == 0xE1) & ((b == 0x9A) | (b == 0xA0))) | ((a == 0xE3) & (b == 0x80) & (c == 0x80))


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values between each two offsets."""
    running = np.concatenate(([0], np.cumsum(values)))
    return running[offsets[1:]] - running[offsets[:-1]]
