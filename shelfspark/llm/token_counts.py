"""Token counts by a finite-state transducer that is compiled from a piece vocabulary.

Pieces merge by score, best first, leftmost on ties. What a prefix of the text encodes to is fixed by its last token
and by a shorter prefix: a token may follow another just when the two, encoded together, stay
as they are. So a state needs the last token, and the number of tokens since, at each place
where a piece that is still growing may have begun. Each transition carries the change of the count.
States are compiled when a text first reaches them. Where no piece holds two neighbouring characters, the text falls
apart. A text is cut before its spaces: a chunk maps an entry state to an exit state and a count. The maps of a slice's
chunks, each over all entry states that can occur, are composed in a parallel prefix scan, which gives every chunk its entry
state and so its count. Chunks that leave the first state, whatever they were entered in, are constant maps.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from shelfspark.llm.batches import per_text, slices, whole

SPACE = "▁"
#: States and chunk maps are kept up to these numbers by each Python worker; they are compiled anew beyond.
KEPT_STATES = 200_000
KEPT_CHUNKS = 150_000


class Transducer:
    """Counts tokens character by character. A state is (last characters, per distance back: None or
    (last token there, tokens there less tokens here))."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.alphabet = frozenset("".join(scores))
        self.neighbours = {p[i : i + 2] for p in scores for i in range(len(p) - 1)}
        self.growing = {p[:k] for p in scores for k in range(1, len(p))}
        # A piece with a space after another character joins words, so texts do not fall apart there.
        self.joins = any(b == SPACE != a for a, b in self.neighbours)
        self._forget()

    def _forget(self) -> None:
        start = ("", (("", 0),))
        self.number = {start: 0}
        self.states = [start]
        self.moves: list[dict[str, tuple[int, int]]] = [{}]
        self.follows: dict[tuple[str, str], bool] = {}
        self.chunks: dict[tuple[int, str], tuple[int, int]] = {}

    def _merged(self, text: str) -> list[str]:
        parts = list(text)
        while True:
            pairs = [(self.scores[p], -i) for i in range(len(parts) - 1) if (p := parts[i] + parts[i + 1]) in self.scores]
            if not pairs:
                return parts
            i = -max(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _may_follow(self, before: str, token: str) -> bool:
        known = self.follows.get((before, token))
        if known is None:
            known = self._merged(before + token) == ([before, token] if before else [token])
            self.follows[before, token] = known
        return known

    def _compile(self, state: int, char: str) -> tuple[int, int]:
        seen, back = self.states[state]
        if seen and seen[-1] + char not in self.neighbours:
            seen, back = self.states[0]
        seen += char
        for size in range(min(len(seen), len(back)), 0, -1):
            token, place = seen[-size:], back[size - 1]
            if place and (size == 1 or token in self.scores) and self._may_follow(place[0], token):
                break
        added = place[1] + 1
        now: list[tuple[str, int] | None] = [(token, 0)]
        for k in range(1, min(len(seen), len(back)) + 1):
            place = back[k - 1]
            now.append((place[0], place[1] - added) if place and seen[-k:] in self.growing else None)
        while now[-1] is None:
            now.pop()
        new = (seen[-max(1, len(now) - 1) :], tuple(now))
        if new not in self.number:
            self.number[new] = len(self.states)
            self.states.append(new)
            self.moves.append({})
        self.moves[state][char] = self.number[new], added
        return self.number[new], added

    def chunk(self, entry: int, chunk: str) -> tuple[int, int]:
        """The chunk's map at one entry state: exit state and tokens added."""
        state, count = entry, 0
        for char in chunk:
            move = self.moves[state].get(char)
            if move is None:
                if char not in self.alphabet:  # one token for each byte, and nothing merges with it
                    state, count = 0, count + len(char.encode())
                    continue
                move = self._compile(state, char)
            state, added = move
            count += added
        return state, count

    def known(self, entry: int, chunk: str) -> tuple[int, int]:
        """The chunk's map at one entry state: the state that the next chunk is entered in, and the tokens added. It is kept."""
        found = self.chunks.get((entry, chunk))
        if found is None:
            if len(self.chunks) >= KEPT_CHUNKS:
                self.chunks.clear()
            state, added = self.chunk(entry, chunk)
            seen = self.states[state][0]
            found = self.chunks[entry, chunk] = state if seen and seen[-1] + SPACE in self.neighbours else 0, added
        return found

    def _maps(self, names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The entry states that can occur, first state first; a map over their numbers per kind of chunk, the constant one
        first; and the number of each chunk's map."""
        own = [k for k, n in enumerate(names) if not n or n[-1] + SPACE in self.neighbours]
        entries, exits = [0], []
        number = {0: 0}
        for entry in entries:  # grows
            exits.append([])
            for k in own:
                state = self.known(entry, SPACE + names[k])[0]
                if state not in number:
                    number[state] = len(entries)
                    entries.append(state)
                exits[-1].append(number[state])
        kinds = np.zeros(len(names), np.int64)
        kinds[own] = np.arange(1, len(own) + 1)
        maps = np.vstack((np.zeros((1, len(entries)), np.int64), np.array(exits, np.int64).reshape(len(entries), len(own)).T))
        return np.array(entries, np.int64), maps, kinds

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text."""
        if len(self.states) > KEPT_STATES:
            self._forget()
        spaced = pc.replace_substring(texts, SPACE, " ")
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        if self.joins:  # most chunks differ by what they are entered in, so their maps are applied one after another
            return np.where(empty, 0, np.array([self._folded(t) for t in spaced.to_pylist()], np.int64))
        words = pc.split_pattern(spaced, " ")
        offsets = words.offsets.to_numpy().astype(np.int64)
        coded = words.flatten().dictionary_encode()
        names, index = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        entries, maps, kinds = self._maps(names)
        before = np.zeros(len(index), np.int64)
        before[1:] = kinds[index[:-1]]
        before[offsets[:-1]] = 0  # a text is entered in the first state
        entry = scanned(maps, before)
        pair, where = np.unique(entry * len(names) + index, return_inverse=True)
        at, word = np.divmod(pair, len(names))
        value = [self.known(e, SPACE + names[w])[1] for e, w in zip(entries[at].tolist(), word.tolist(), strict=True)]
        return np.where(empty, 0, per_text(np.array(value, np.int64)[where], offsets))

    def _folded(self, text: str) -> int:
        state = count = 0
        for word in text.split(" "):
            state, added = self.known(state, SPACE + word)
            count += added
        return count


def scanned(maps: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where the composition of all maps up to each position leads, given the number of each position's map.

    ``maps`` has a row per map, of which row 0 is the constant 0 and must be the first position's. Rounds compose the maps of
    twice as many positions each; equal compositions have one number and are composed once, and constant ones are done.
    """
    rows = [tuple(m) for m in maps.tolist()]
    number = {}
    own = np.array([number.setdefault(m, len(number)) for m in rows], np.int64)
    rows = list(number)
    prefix, reach = own[kinds], 1
    constant = np.array([len(set(m)) == 1 for m in rows], bool)
    live = np.flatnonzero(~constant[prefix])
    while len(live):
        pairs, where = np.unique(prefix[live - reach] << 32 | prefix[live], return_inverse=True)
        found = []
        for first, then in zip((pairs >> 32).tolist(), (pairs & 0xFFFFFFFF).tolist(), strict=True):
            composed = tuple(rows[then][e] for e in rows[first])
            if composed not in number:
                number[composed] = len(rows)
                rows.append(composed)
            found.append(number[composed])
        prefix[live] = np.array(found, np.int64)[where]
        constant = np.array([len(set(m)) == 1 for m in rows], bool)
        live, reach = live[~constant[prefix[live]]], 2 * reach
    return np.array([m[0] for m in rows], np.int64)[prefix]


@lru_cache(maxsize=2)
def transducer(model: str) -> Transducer:
    """For a piece model with merges by score, byte tokens for unknown characters, a space before the text and
    no other change to it."""
    pieces = sentencepiece.SentencePieceProcessor(model_file=model)
    special = (pieces.is_byte, pieces.is_control, pieces.is_unknown, pieces.is_unused)
    ids = (i for i in range(pieces.get_piece_size()) if not any(f(i) for f in special))
    return Transducer({pieces.id_to_piece(i): pieces.get_score(i) for i in ids})


def count_tokens(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", limit: int = 4096) -> DataFrame:
    """One row per document: ``key``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.

    Null and empty texts have 0 bytes and tokens; repeated rows are counted each; other columns are not read, whatever their
    names; an empty table gives no rows. A text longer than a slice is a slice of its own. ``model`` is a path that every
    executor has.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = transducer(model)
        for batch in slices(batches, "text"):
            texts = whole(batch.column("text"))
            tokens = own.counts(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pc.binary_length(texts).cast(pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array(tokens > limit),
                ],
                names=["key", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = dict(docs.dtypes)[key]
    counted = docs.selectExpr(f"`{key}` AS key", f"`{text}` AS text").mapInArrow(
        count, f"key {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
    return counted.withColumnRenamed("key", key)
