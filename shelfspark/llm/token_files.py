"""Token ids in files that are compressed by a grammar: Re-Pair over 16-bit symbols.

A file is a Parquet table. A row is a shard: whole documents of about ``SHARD_IDS`` ids, in ascending order of their keys.

| column | content |
|---|---|
| part, shard | place of the shard: order of the key ranges, then number within the range |
| before | ids of earlier shards of the same part |
| keys, ends | per document the key and the end of its symbols in ``symbols`` |
| counts | per document the number of ids |
| rules | little-endian 16-bit pairs: what the symbols ``first_rule``, ``first_rule`` + 1, ... stand for |
| lengths | little-endian 32-bit: ids in the expansion of each rule |
| symbols | little-endian 16-bit: the compressed ids |
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfspark.llm.batches import WHITE, chunked, cuts_hold, slices, white_before, whole
from shelfspark.llm.frames import named

#: Ids in a shard; a longer document is a shard of its own.
SHARD_IDS = 1 << 20
#: A pair that occurs less often in a shard is left alone: pairs are replaced as long as one repeats.
LEAST_PAIRS = 2
#: Pairs replaced in a round, at most: pairs that share no symbol as left and right do not overlap.
ROUND_PAIRS = 2048
SYMBOLS = 1 << 16
#: Repeated chunks that a Python worker keeps with their ids; further ones are encoded anew.
KEPT = 250_000
#: Bytes of text whose distinct chunks are encoded together, chunks in a text for the library, and chunks in one call.
TEXT_BYTES, RUN, BATCH = 16 << 20, 128, 1 << 15

SCHEMA = (
    "part int, shard int, before bigint, keys array<bigint>, ends array<bigint>, counts array<bigint>, "
    "first_rule int, rules binary, lengths binary, symbols binary"
)


class Grammar:
    """Symbols with the rules they are made of; symbols below ``first`` are ids. ``lengths`` are the stored numbers of ids in the
    expansions of the rules."""

    def __init__(self, first: int, rules: np.ndarray, symbols: np.ndarray, lengths: np.ndarray):
        self.first, self.rules, self.symbols = first, rules.reshape(-1, 2).astype(np.int64), symbols
        self.lengths = np.concatenate((np.ones(first, np.int64), lengths.astype(np.int64)))
        self._spelt: tuple[np.ndarray, np.ndarray] | None = None

    def _expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of every symbol one after another, and where each symbol's begin. All rules are opened at once, a level
        at a time: what a rule stands for is read off its two symbols until only ids are left."""
        if self._spelt is None:
            flat = self._open(np.arange(len(self.lengths)))
            self._spelt = flat, np.cumsum(self.lengths) - self.lengths
        return self._spelt

    def _open(self, part: np.ndarray, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop`` of a row of symbols. Before each level symbols outside of them are let go, so rules are
        only opened where they hold wanted ids."""
        wanted = None if stop is None else stop - start
        while True:
            if wanted is not None:
                ends = np.cumsum(self.lengths[part])
                a, b = np.searchsorted(ends, [start, start + max(wanted, 1) - 1], side="right")
                start -= int(ends[a - 1]) if a else 0
                part = part[a : b + 1]
            rule = part >= self.first
            if not rule.any():
                return part.astype(np.int32) if wanted is None else part[start : start + wanted].astype(np.int32)
            size = 1 + rule
            at = np.cumsum(size) - size
            opened = np.empty(int(size.sum()), np.int64)
            opened[at[~rule]] = part[~rule]
            pairs = self.rules[part[rule] - self.first]
            opened[at[rule]], opened[at[rule] + 1] = pairs[:, 0], pairs[:, 1]
            part = opened

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """The ids that the symbols from ``start`` to ``stop`` stand for."""
        part = self.symbols[start:stop].astype(np.int64)
        flat, begins = self._expansions()
        size = self.lengths[part]
        shift = np.repeat(begins[part] - (np.cumsum(size) - size), size)
        return flat[shift + np.arange(len(shift))]

    def slice(self, start: int, stop: int, first_symbol: int = 0, last_symbol: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop`` of those symbols."""
        part = self.symbols[first_symbol:last_symbol].astype(np.int64)
        return self._open(part, start, max(start, min(stop, int(self.lengths[part].sum()))))


def rule_lengths(first: int, rules: np.ndarray) -> np.ndarray:
    """Ids in the expansion of each rule: a level of rules at a time, those whose symbols are known."""
    lengths = np.concatenate((np.ones(first, np.int64), np.zeros(len(rules), np.int64)))
    pairs = rules.reshape(-1, 2).astype(np.int64)
    while (open_ := np.flatnonzero(lengths[first:] == 0)).size:
        left, right = lengths[pairs[open_, 0]], lengths[pairs[open_, 1]]
        lengths[first + open_] = np.where((left > 0) & (right > 0), left + right, 0)
    return lengths[first:]


def compress(ids: np.ndarray, last: np.ndarray, first: int, least: int = LEAST_PAIRS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair: symbols, which of them end a document, and rules. Pairs do not reach over the end of a document.

    Each round counts all pairs by sorting them and replaces the most frequent ones; it ends when no pair is as frequent as
    ``least`` or all 16-bit symbols are taken.
    """
    # The last symbol is given out only when the rounds end, so a pair of it marks the ends of documents.
    end = np.uint32(SYMBOLS * SYMBOLS - 1)
    symbols, ends, rules = ids.astype(np.uint16), np.flatnonzero(last), [np.empty(0, np.uint32)]
    used = first
    while used < SYMBOLS and len(symbols) > 1:
        pairs = symbols[:-1].astype(np.uint32)
        pairs <<= 16
        pairs |= symbols[1:]
        pairs[ends[:-1] if len(ends) and ends[-1] == len(pairs) else ends] = end
        chosen = _frequent(pairs, end, least, min(ROUND_PAIRS, SYMBOLS - used))
        if not len(chosen):
            break
        at, slot = _places(pairs, chosen)
        # Only equal neighbours overlap: of a run of such pairs, every second one is taken.
        equal = np.flatnonzero((chosen >> 16) == (chosen & 0xFFFF))
        if len(equal):
            place = np.arange(len(at))
            begins = np.ones(len(at), bool)
            begins[1:] = at[1:] != at[:-1] + 1
            own = (place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0
            at, slot = at[own], slot[own]
        symbols[at] = (used + slot).astype(np.uint16)
        stays = np.ones(len(symbols), bool)
        stays[at + 1] = False
        symbols = symbols[stays]
        ends -= np.searchsorted(at, ends)
        rules.append(chosen)
        used += len(chosen)
    marks = np.zeros(len(symbols), bool)
    marks[ends] = True
    pairs = np.concatenate(rules)
    return symbols, marks, np.stack((pairs >> 16, pairs & 0xFFFF), axis=1).astype(np.uint16)


def _frequent(pairs: np.ndarray, end: np.uint32, least: int, most: int) -> np.ndarray:
    """Up to ``most`` of the ROUND_PAIRS most frequent pairs, none left in one and right in another, in ascending order."""
    ordered = np.sort(pairs)
    begins = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    count = np.diff(begins, append=len(ordered))
    often = count >= least
    own, count = ordered[begins[often]], count[often]
    if len(own) and own[-1] == end:
        own, count = own[:-1], count[:-1]
    if not len(count):
        return own
    among = np.arange(len(count))
    if len(count) > ROUND_PAIRS:
        among = np.flatnonzero(count >= np.partition(count, -ROUND_PAIRS)[-ROUND_PAIRS])
    chosen: list[int] = []
    role = bytearray(SYMBOLS)  # bit 1: left in a chosen pair, bit 2: right
    for pair in own[among[np.argsort(-count[among], kind="stable")]].tolist():
        a, b = pair >> 16, pair & 0xFFFF
        if not role[a] & 2 and not role[b] & 1 and (a != b or not role[a]):
            chosen.append(pair)
            role[a] |= 1
            role[b] |= 2
            if len(chosen) == most:
                break
    return np.sort(np.array(chosen, np.uint32))


def _places(pairs: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the chosen pairs occur, and which of them each is. A table by hash leaves few places to look up."""
    marked = np.zeros(1 << 16, bool)
    marked[(chosen * np.uint32(0x9E3779B1)) >> 16] = True
    mixed = pairs * np.uint32(0x9E3779B1)
    mixed >>= 16
    at = np.flatnonzero(marked[mixed])
    found = pairs[at]
    slot = np.minimum(np.searchsorted(chosen, found), len(chosen) - 1)
    hit = chosen[slot] == found
    return at[hit], slot[hit]


class _Encoder:
    """Encodes chunks with the library, many of them in one text. ``pattern`` is what the tokenizer itself cuts texts by, so it
    keeps chunks apart where one ends and the next begins with white space; where the next does not, and where an added
    token is in a chunk, the chunk goes to the library alone. Chunks that repeat are kept. Texts with added tokens, and all texts
    if the pattern's words reach over the cuts, are encoded whole."""

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.cuts = Tokenizer.from_file(path), cuts_hold(pattern)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Byte-level tokens are written with a character for each byte that they stand for.
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]
        self.names, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's end."""
        names, index, offsets = chunked(texts, self._whole(texts))
        place = pc.index_in(names, value_set=self.names)
        new = place.is_null().to_numpy(zero_copy_only=False)
        place = place.fill_null(0).to_numpy().astype(np.int64)
        fresh = names.filter(pa.array(new))
        place[new] = len(self.names) + np.arange(len(fresh))
        known = pa.concat_arrays([self.ids, self._encoded(fresh)])
        found = known.take(pa.array(place[index]))
        # Chunks that occur once are not kept, most of them never come again. A full store begins anew.
        often = np.bincount(index, minlength=len(names)) > 1
        full = len(self.names) + np.count_nonzero(often & new) > KEPT
        chosen = np.flatnonzero(often if full else often & new)[:KEPT]
        more, their = names.take(pa.array(chosen)), known.take(pa.array(place[chosen]))
        self.names, self.ids = (more, their) if full else (pa.concat_arrays([self.names, more]), pa.concat_arrays([self.ids, their]))
        ends = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1) // 2
        return np.frombuffer(found.buffers()[2] or b"", np.uint16), ends[offsets[1:]]

    def _whole(self, texts: pa.Array) -> np.ndarray:
        """Which texts hold an added token; all of them if nothing may be cut."""
        held = pa.array(np.full(len(texts), not self.cuts))
        for token in self.added:
            held = pc.or_(held, pc.match_substring(texts, token))
        return held.to_numpy(zero_copy_only=False)

    def _encoded(self, names: pa.Array) -> pa.Array:
        """Ids of each chunk as 16-bit numbers."""
        ends = np.frombuffer(names.buffers()[1], np.int64, len(names) + 1)
        data = np.frombuffer(names.buffers()[2] or b"", np.uint8)
        joins = np.isin(data[ends[:-1]], list(WHITE)) & ((data[ends[1:] - 1] > 32) & (data[ends[1:] - 1] != 127))
        joins &= ~white_before(data, ends[1:]) & ~self._whole(names)
        ids, sizes = [], np.zeros(len(names), np.int64)
        for rows, run in ((np.flatnonzero(joins), RUN), (np.flatnonzero(~joins), 1)):
            for start in range(0, len(rows), BATCH):
                part = rows[start : start + BATCH]
                flat, sizes[part] = self._library(names.take(pa.array(part)), run)
                ids.append(flat)
        order = np.argsort(np.concatenate((np.flatnonzero(joins), np.flatnonzero(~joins))))
        flat = np.concatenate(ids) if ids else np.empty(0, np.uint16)
        own = sizes[joins], sizes[~joins]
        ends = np.concatenate(([0], np.cumsum(np.concatenate(own)))) * 2
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(names), [None, pa.py_buffer(ends), pa.py_buffer(flat)]).take(pa.array(order))

    def _library(self, names: pa.Array, run: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks that go to the library ``run`` at a time, and the number of each."""
        ends = np.frombuffer(names.buffers()[1], np.int64, len(names) + 1)
        stops = np.append(ends[:-1:run], ends[-1])
        texts = pa.LargeStringArray.from_buffers(len(stops) - 1, pa.py_buffer(stops), names.buffers()[2]).to_pylist()
        found = [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.fromiter(chain.from_iterable(found), np.int64)
        if run == 1:
            return flat.astype(np.uint16), np.array([len(x) for x in found], np.int64)
        # Ids belong to the chunk that their bytes lie in.
        spelt = np.cumsum(self.bytes[flat])
        last = np.searchsorted(spelt, ends[1:])
        if not len(spelt) or spelt[-1] != ends[-1] or (spelt[last] != ends[1:]).any():
            return self._library(names, 1)
        return flat.astype(np.uint16), np.diff(last, prepend=-1)


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> _Encoder:
    return _Encoder(path, pattern)


class _Shards:
    """Gathers documents of one part and gives a row for each full shard."""

    def __init__(self, part: int, first: int):
        self.part, self.first, self.shard, self.before = part, first, 0, 0
        self._empty()

    def _empty(self) -> None:
        self.keys: list[int | None] = []
        self.counts: list[int] = []
        self.ids: list[np.ndarray] = []
        self.size = 0

    def add(self, key: int | None, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        if self.size and self.size + len(ids) > SHARD_IDS:
            yield self.row()
        self.keys.append(key)
        self.counts.append(len(ids))
        self.ids.append(ids)
        self.size += len(ids)

    def row(self) -> pa.RecordBatch:
        ids = np.concatenate(self.ids)
        last = np.zeros(len(ids), bool)
        last[np.cumsum(self.counts) - 1] = True
        symbols, last, rules = compress(ids, last, self.first)
        lengths = rule_lengths(self.first, rules)
        values = {
            "part": self.part,
            "shard": self.shard,
            "before": self.before,
            "keys": self.keys,
            "ends": (np.flatnonzero(last) + 1).tolist(),
            "counts": self.counts,
            "first_rule": self.first,
            "rules": rules.astype("<u2").tobytes(),
            "lengths": lengths.astype("<u4").tobytes(),
            "symbols": symbols.astype("<u2").tobytes(),
        }
        kinds = (pa.int32(), pa.int32(), pa.int64(), *[pa.list_(pa.int64())] * 3, pa.int32(), *[pa.binary()] * 3)
        self.shard, self.before = self.shard + 1, self.before + self.size
        self._empty()
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values.values(), kinds, strict=True)], names=list(values))


def write_tokens(
    docs: DataFrame, tokenizer: str, pattern: str, path: str, end_id: int, key: str = "doc_id", text: str = "text"
) -> None:
    """Encode every text, append ``end_id`` and write the shards below ``path``.

    Documents lie in ascending order of their whole-number keys, null first; rows that repeat with their key
    lie side by side. Null and empty texts are the end id alone. An empty table writes no shard. A text of more ids than a
    shard is a shard of its own; other columns are not read, whatever their names.
    ``tokenizer`` is a file that every executor has and ``pattern`` the one it cuts texts by; its vocabulary must leave
    16-bit symbols free.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, pattern)
        shards = _Shards(TaskContext.get().partitionId(), max(own.tokenizer.get_vocab_size(), end_id + 1))
        end = np.array([end_id], np.uint16)
        for batch in slices(batches, "text", TEXT_BYTES):
            ids, ends = own.texts(whole(batch.column("text")))
            start = 0
            for doc, stop in zip(batch.column("key").to_pylist(), ends.tolist(), strict=True):
                yield from shards.add(doc, np.concatenate((ids[start:stop], end)))
                start = stop
        if shards.size:
            yield shards.row()

    # The position splits the rows of a key that repeats often over several ranges.
    place = F.monotonically_increasing_id().alias("place")
    rows = docs.select(named(key).cast("bigint").alias("key"), place, named(text).alias("text"))
    ranged = rows.repartitionByRange("key", "place").sortWithinPartitions("key", "place")
    ranged.select("key", "text").mapInArrow(encode, SCHEMA).write.parquet(path)


def grammar(row: dict) -> Grammar:
    parts = (np.frombuffer(row[name], kind) for name, kind in (("rules", "<u2"), ("symbols", "<u2"), ("lengths", "<u4")))
    return Grammar(row["first_rule"], *parts)


def shard_documents(row: dict) -> Iterator[tuple[int | None, np.ndarray]]:
    """Key and ids of each document of a shard."""
    own = grammar(row)
    ids, start = own.ids(), 0
    stops = np.cumsum(own.lengths[own.symbols])[np.array(row["ends"], np.int64) - 1]
    for key, stop in zip(row["keys"], stops.tolist(), strict=True):
        yield key, ids[start:stop]
        start = stop


def read_ids(row: dict, document: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of the shard's n-th document, expanding only the symbols that hold them."""
    first = row["ends"][document - 1] if document else 0
    return grammar(row).slice(start, min(stop, row["counts"][document]), first, row["ends"][document])


def read_tokens(spark, path: str) -> DataFrame:
    """One row per document of the files: ``key``, ``start`` (ids of all documents before it), ``n_tokens`` and ``crc32``
    of its ids as little-endian 32-bit numbers."""
    shards = spark.read.schema(SCHEMA).parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                keys, starts, counts, sums, at = [], [], [], [], row["before"]
                for key, ids in shard_documents(row):
                    keys.append(key)
                    starts.append(at)
                    counts.append(len(ids))
                    sums.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    at += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * len(keys), pa.int32()), *(pa.array(x, pa.int64()) for x in (keys, starts, counts, sums))],
                    names=["part", "key", "start", "n_tokens", "crc32"],
                )

    found = shards.mapInArrow(decode, "part int, key bigint, start bigint, n_tokens bigint, crc32 bigint")
    # One row per part of the files: the parts before each are summed up without the documents.
    ids = shards.select("part", F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, n: a + n).alias("ids"))
    sums = ids.groupBy("part").agg(F.sum("ids").alias("ids"))
    before = F.sum("ids").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    bases = sums.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    return found.join(bases, "part").select("key", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "crc32")
