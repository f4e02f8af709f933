"""Byte-level BPE by rank files: recursive DuckDB queries in each partition contract the pairs of words."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.batches import chunked, cuts_hold, per_text, slices, whole

#: Repeated chunks that a Python worker keeps with their ids; further ones are encoded anew.
KEPT = 250_000
#: Bytes of text whose distinct chunks are encoded together.
TEXT_BYTES = 16 << 20
#: Words of more bytes than this take many rounds and are contracted in queries of their own.
LONG_WORD = 64
#: Rows that the rounds of one query leave, at most, unless a single word has more.
ROUND_ROWS = 1_000_000

# A row is a token at a place: word * 2^32 + byte offset, so the next token's place is its own plus the token's size.
# Each round joins neighbours with the merge table and contracts, in each word, the leftmost pair of lowest rank: the least
# number made of rank, offset and the sizes of the left token and of both, a byte each. A word without pairs
# drops out. Every round's tokens stay, and the last of each word are its ids.
CONTRACT = """
WITH RECURSIVE token(place, id, size, round) AS (
  SELECT place, id, 1::bigint AS size, 0 AS round FROM start
  UNION ALL
  (WITH first AS (
     SELECT a.place >> 32 AS word,
       min((m.merged::bigint << 24) + ((a.place & 255) << 16) + (a.size << 8) + a.size + b.size) AS turn
     FROM token a JOIN token b ON b.place = a.place + a.size JOIN merges m ON m.pair = (a.id::bigint << 32) + b.id
     GROUP BY 1
   ), pair AS (
     SELECT word, (turn >> 24)::int AS merged, (word << 32) + ((turn >> 16) & 255) AS place,
       (word << 32) + ((turn >> 16) & 255) + ((turn >> 8) & 255) AS right_place, turn & 255 AS size
     FROM first
   )
   SELECT t.place, CASE WHEN t.place = f.place THEN f.merged ELSE t.id END,
     CASE WHEN t.place = f.place THEN f.size ELSE t.size END, t.round + 1
   FROM token t JOIN pair f ON f.word = t.place >> 32 WHERE t.place <> f.right_place)
), done AS (
  SELECT place >> 32 AS word, max(round) AS round FROM token GROUP BY 1
)
SELECT d.word::int AS word, list(t.id ORDER BY t.place) AS ids
FROM token t JOIN done d ON d.word = t.place >> 32 AND d.round = t.round GROUP BY 1 ORDER BY 1
"""
# The same for long words, of which only the latest state is kept. Where merging cannot bring up a pair of lower rank
# (calm), a round contracts every pair of lowest rank that overlaps none before it.
CONTRACT_LONG = """
WITH RECURSIVE token(place, id, size) USING KEY (place) AS (
  SELECT place, id, 1 AS size FROM start
  UNION
  (WITH live AS (
     SELECT place, id, size FROM recurring.token
     WHERE id >= 0 AND place >> 32 IN (SELECT DISTINCT place >> 32 FROM token)
   ), pair AS (
     SELECT a.place, b.place AS right_place, a.size + b.size AS size, m.merged, m.calm
     FROM live a JOIN live b ON b.place = a.place + a.size JOIN merges m ON m.pair = (a.id::bigint << 32) + b.id
   ), lowest AS (
     SELECT place >> 32 AS word, min(merged) AS merged FROM pair GROUP BY 1
   ), hit AS (
     SELECT p.*, coalesce(lag(right_place) OVER (PARTITION BY p.place >> 32 ORDER BY p.place) = p.place, false) AS meets
     FROM pair p JOIN lowest w ON w.word = p.place >> 32 AND w.merged = p.merged
   ), row_of AS (
     SELECT *, sum(CASE WHEN meets THEN 0 ELSE 1 END) OVER (PARTITION BY place >> 32 ORDER BY place) AS no FROM hit
   ), ranked AS (
     SELECT *, row_number() OVER (PARTITION BY place >> 32, no ORDER BY place) AS k FROM row_of
   ), chosen AS (
     SELECT * FROM ranked WHERE k % 2 = 1 AND (calm OR (no = 1 AND k = 1))
   )
   SELECT place, merged, size FROM chosen UNION ALL SELECT right_place, -1, 0 FROM chosen)
)
SELECT (place >> 32)::int AS word, list(id ORDER BY place) AS ids FROM token WHERE id >= 0 GROUP BY 1 ORDER BY 1
"""
# Token bytes travel as hex digits, which can be aggregated as text.
SPELL = """
SELECT unhex(string_agg(t.digits, '' ORDER BY i.place)) AS spelt
FROM ids i JOIN tokens t ON t.id = i.id GROUP BY i.item ORDER BY i.item
"""


def _groups(sizes: np.ndarray) -> Iterator[tuple[str, int, int]]:
    """Words to contract in one query, given their numbers of bytes in ascending order: short ones by the rows that they leave,
    ROUND_ROWS at most, long ones by their number of bytes."""
    rows = np.cumsum(np.where(sizes > LONG_WORD, sizes, sizes * sizes // 2))
    long = int(np.searchsorted(sizes, LONG_WORD, side="right"))
    start = 0
    while start < len(sizes):
        before = rows[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(rows, before + ROUND_ROWS, side="right")))
        if start < long:
            stop = min(stop, long)
        yield CONTRACT if start < long else CONTRACT_LONG, start, stop
        start = stop


def _binary(ends: np.ndarray, data: pa.Buffer | np.ndarray) -> pa.Array:
    """Byte strings that lie one after another."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])


def _ends(column: pa.Array) -> np.ndarray:
    """Where the first byte string begins and each one ends in the data of an array that is no slice."""
    return np.frombuffer(column.buffers()[1], np.int64, len(column) + 1)


def _joined(column: pa.Array, ends: np.ndarray) -> pa.Array:
    """Byte strings ``ends[i]`` to ``ends[i + 1]`` joined, for each i."""
    return _binary(_ends(column)[ends], column.buffers()[2] or b"")


def _running(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))


class Ranks:
    """A rank file in an in-memory database of this process: ``tokens`` and ``merges``."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines)}
        self.pattern, self.cuts = regex.compile(pattern), cuts_hold(pattern)
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        rows = [
            (self.rank[t[:i]], self.rank[t[i:]], own)
            for t, own in self.rank.items()
            for i in range(1, len(t))
            if t[:i] in self.rank and t[i:] in self.rank
        ]
        left, right, merged = (np.array(c, np.int32) for c in zip(*rows, strict=True))
        least = np.full(max(self.rank.values()) + 1, np.iinfo(np.int32).max, np.int32)
        np.minimum.at(least, left, merged)
        np.minimum.at(least, right, merged)
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "250MB"})
        pair = (left.astype(np.int64) << 32) + right  # one key, so that neighbours are joined first
        merges = pa.table({"pair": pair, "merged": merged, "calm": least[merged] > merged})
        tokens = pa.table({"id": list(self.rank.values()), "digits": [t.hex() for t in self.rank]})
        self.tokens, self.own = pa.array(list(self.rank), pa.large_binary()), np.array(list(self.rank.values()), np.int32)
        self.decimal = pa.array([b" %d" % i for i in range(int(self.own.max()) + 1)], pa.large_binary())
        none = pa.array([], pa.large_binary())
        self.names, self.kept = pa.array([], pa.large_string()), (none, none, np.empty(0, np.int64))
        for name, table in (("merges", merges), ("tokens", tokens)):
            self.db.register("given", table)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")

    def words(self, words: Iterable[bytes]) -> list[list[int]]:
        """Ids of each word. A word that is a token is that token, as in the public libraries."""
        return self.lists(pa.array(list(words), pa.large_binary())).to_pylist()

    def lists(self, words: pa.Array) -> pa.Array:
        """Ids of each word, given and found in Arrow arrays."""
        place = pc.index_in(words, value_set=self.tokens)
        single = np.flatnonzero(place.is_valid().to_numpy(zero_copy_only=False))
        rest = np.flatnonzero(place.is_null().to_numpy(zero_copy_only=False))
        ids = self.own[place.drop_null().to_numpy()]
        found = [pa.ListArray.from_arrays(pa.array(np.arange(len(single) + 1, dtype=np.int32)), pa.array(ids, pa.int32()))]
        sizes = pc.binary_length(words).to_numpy()
        rest = rest[np.argsort(sizes[rest], kind="stable")]
        sizes, words = sizes[rest], words.take(pa.array(rest))
        ends, data = _running(sizes), self.byte[np.frombuffer(words.buffers()[2] or b"", np.uint8)]
        for query, a, b in _groups(sizes):
            starts = ends[a:b] - ends[a]
            offset = np.arange(ends[b] - ends[a]) - np.repeat(starts, sizes[a:b])
            place = (np.repeat(np.arange(b - a), sizes[a:b]) << 32) + offset
            self.db.register("start", pa.table({"place": place, "id": data[ends[a] : ends[b]]}))
            found += self.db.sql(query).to_arrow_table().column("ids").chunks
            self.db.unregister("start")
        order = np.argsort(np.concatenate((single, rest)))
        return pa.concat_arrays([x.cast(pa.list_(pa.int32())) for x in found]).take(pa.array(order))

    def chunked(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Texts cut by ``chunked``, or one chunk each if words reach over its cuts."""
        return chunked(whole(texts), None if self.cuts else np.ones(len(texts), bool))

    def _parts(self, chunks: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The distinct words of chunks, the index of each word in order, and the offsets of the chunks."""
        parts = [self.pattern.findall(c) for c in chunks.to_pylist()]
        coded = pa.array(list(chain.from_iterable(parts)), pa.large_string()).dictionary_encode()
        return coded.dictionary.cast(pa.large_binary()), coded.indices.to_numpy(), _running([len(p) for p in parts])

    def chunks(self, chunks: pa.Array) -> pa.Array:
        """Ids of each chunk of ``chunked``."""
        words, index, offsets = self._parts(chunks)
        found = self.lists(words).take(pa.array(index))
        return pa.LargeListArray.from_arrays(found.offsets.to_numpy()[offsets].astype(np.int64), found.values)

    def round_trips(self, chunks: pa.Array, counts: np.ndarray) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """For each chunk its ids in decimal with a space before each, the bytes that they decode to and their number.
        ``counts`` tells which chunks occur repeatedly and are worth keeping."""
        place = pc.index_in(chunks, value_set=self.names)
        new = place.is_null().to_numpy(zero_copy_only=False)
        place = place.fill_null(0).to_numpy().astype(np.int64)
        place[new] = len(self.names) + np.arange(np.count_nonzero(new))
        words, index, offsets = self._parts(chunks.filter(pa.array(new)))
        lists = self.lists(words)
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        digits = _joined(self.decimal.take(pa.array(flat)), ends).take(pa.array(index))
        spelt = self.spell(flat, np.diff(ends)).take(pa.array(index))
        made = _joined(digits, offsets), _joined(spelt, offsets), per_text(np.diff(ends)[index], offsets)
        known = [*(pa.concat_arrays([a, b]) for a, b in zip(self.kept[:2], made[:2], strict=True)), np.concatenate((self.kept[2], made[2]))]
        self._keep(chunks, place, new, counts > 1, known)
        at = pa.array(place)
        return known[0].take(at), known[1].take(at), known[2][place]

    def _keep(self, chunks: pa.Array, place: np.ndarray, new: np.ndarray, often: np.ndarray, known: list) -> None:
        """Keeps repeated chunks for further slices. A full store begins anew with those of this one."""
        full = len(self.names) + np.count_nonzero(often & new) > KEPT
        chosen = np.flatnonzero(often if full else often & new)[:KEPT]
        names, at = chunks.take(pa.array(chosen)), place[chosen]
        if not full:
            names, at = pa.concat_arrays([self.names, names]), np.concatenate((np.arange(len(self.names)), at))
        self.names, self.kept = names, (known[0].take(pa.array(at)), known[1].take(pa.array(at)), known[2][at])

    def spell(self, ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """The bytes of lists of ids that lie one after another."""
        rows = pa.table({"item": np.repeat(np.arange(len(sizes)), sizes), "place": np.arange(len(ids)), "id": ids})
        self.db.register("ids", rows)
        found = self.db.sql(SPELL).to_arrow_table().column("spelt").cast(pa.large_binary()).combine_chunks()
        self.db.unregister("ids")
        # A list without ids has no row.
        ends = np.zeros(len(sizes) + 1, np.int64)
        ends[1:][sizes > 0] = pc.binary_length(found).to_numpy()
        return _binary(np.cumsum(ends), b"".join(found.to_pylist()))


@lru_cache(maxsize=2)
def ranks(path: str, pattern: str) -> Ranks:
    return Ranks(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key`` and ``ids`` (array of int). Null and empty texts have an empty array,
    repeated rows are encoded each, other columns are not read. ``path`` is a rank file that every executor has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ranks(path, pattern)
        for batch in slices(batches, "text", TEXT_BYTES):
            names, index, offsets = own.chunked(batch.column("text"))
            found = own.chunks(names).take(pa.array(index))
            ids = pa.LargeListArray.from_arrays(found.offsets.to_numpy()[offsets], found.values)
            yield pa.RecordBatch.from_arrays([batch.column("key"), ids.cast(pa.list_(pa.int32()))], names=["key", "ids"])

    rows = docs.selectExpr(f"`{key}` AS key", f"`{text}` AS text")
    return rows.mapInArrow(run, f"key {dict(docs.dtypes)[key]}, ids array<int>").withColumnRenamed("key", key)


def decode(encoded: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """One row per row of ``encoded``: ``key`` and ``decoded`` (binary). A null array decodes to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ranks(path, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                lists = part.column("ids")
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
                spelt = own.spell(lists.flatten().to_numpy(), sizes)
                yield pa.RecordBatch.from_arrays([part.column("key"), spelt.cast(pa.binary())], names=["key", "decoded"])

    rows = encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    return rows.mapInArrow(run, f"key {dict(encoded.dtypes)[key]}, decoded binary").withColumnRenamed("key", key)


def _digests(parts: pa.Array, offsets: np.ndarray, skip: int) -> pa.Array:
    """Digest of the bytes of the parts between each two offsets, without the first ``skip`` bytes."""
    data, ends = memoryview(parts.buffers()[2] or b""), _ends(parts)[offsets].tolist()
    return pa.array([hashlib.sha256(data[min(a + skip, b) : b]).hexdigest() for a, b in zip(ends, ends[1:], strict=False)], pa.string())


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by one space) and
    ``decoded_sha256`` (of the bytes that the ids decode to), without shipping the ids.

    Null and empty texts have no ids and the digest of nothing. Chunks that repeat in a slice are encoded and
    decoded once; the digests read every chunk of every text in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = ranks(path, pattern)
        for batch in slices(batches, "text", TEXT_BYTES):
            names, index, offsets = own.chunked(batch.column("text"))
            written, spelt, number = own.round_trips(names, np.bincount(index, minlength=len(names)))
            order = pa.array(index)
            lines, contents = (_digests(x.take(order), offsets, skip) for x, skip in ((written, 1), (spelt, 0)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(per_text(number[index], offsets), pa.int64()), lines, contents],
                names=["key", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.selectExpr(f"`{key}` AS key", f"`{text}` AS text")
    kind = dict(docs.dtypes)[key]
    out = rows.mapInArrow(run, f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("key", key)
