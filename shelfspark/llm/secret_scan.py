"""Secret scans: all rules in one automaton that reads every byte once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfspark.llm.automata import BREAK, Automaton, compile_patterns, marks
from shelfspark.llm.batches import slices, whole


@dataclass(frozen=True)
class Rule:
    """``least``: bytes that a match needs, or its value, what follows the first ``:`` or ``=``, if ``value``.
    A shorter match is dropped, but the next one of its kind begins after it."""

    kind: str
    pattern: str
    least: int
    value: bool = False


# The three base kinds and prefixes that issuers of keys publish. Greedy hex runs of 24 and more are
# just the matches of {24,}, which spares a mark on every hex letter.
RULES = (
    Rule(
        "assign",
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
        6,
        True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}", 24),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 27),
)
BASE = ("assign", "access", "hex")


class Scanner:
    """Backwards automaton of all rules for where matches begin, and one for each rule for where they end."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = rules
        self.starts = compile_patterns([r.pattern for r in rules], backwards=True, anywhere=True)
        self.matchers = [compile_patterns([r.pattern]) for r in rules]
        self.tables = [(m.step.tolist(), m.group.tolist(), m.accept.tolist(), m.dead) for m in self.matchers]

    def end(self, rule: int, data: bytes, start: int) -> int:
        """End of the longest match from ``start``."""
        step, group, accept, dead = self.tables[rule]
        state, last = 0, start
        for at in range(start, len(data)):
            state = step[state][group[data[at]]]
            if state == dead:
                break
            if accept[state]:
                last = at + 1
        return last

    def spans(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """For each text (start, rule, end), bytes, leftmost non-overlapping for each rule."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        joined = np.frombuffer(bytes([BREAK]).join(texts), np.uint8)
        at, bits = marks(self.starts, joined[::-1])
        at, bits = len(joined) - 1 - at[::-1], bits[::-1]
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
        owner = np.searchsorted(offsets, at, side="right") - 1
        free: dict[tuple[int, int], int] = {}
        for text, position, found in zip(owner.tolist(), at.tolist(), bits.tolist(), strict=True):
            start = position - int(offsets[text])
            for rule in range(len(self.rules)):
                if found >> rule & 1 and start >= free.get((text, rule), 0):
                    end = free[text, rule] = self.end(rule, texts[text], start)
                    if self._long_enough(self.rules[rule], texts[text][start:end]):
                        out[text].append((start, rule, end))
        return out

    @staticmethod
    def _long_enough(rule: Rule, match: bytes) -> bool:
        if rule.value:
            sign = min(i for i in (match.find(b":"), match.find(b"=")) if i >= 0)
            match = match[sign + 1 :].lstrip(b" ")
            match = match[match[:1] in (b'"', b"'") :]
        return len(match) >= rule.least


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def _code_points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    edges = sorted({e for s, _, t in spans for e in (s, t)})
    seen, last, at = {}, 0, 0
    for e in edges:
        at += len(data[last:e].decode("utf-8", "replace"))
        seen[e], last = at, e
    return [(seen[s], r, seen[t]) for s, r, t in spans]


def find_secrets(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """One row per document: ``key``, ``kinds``, ``starts``, ``ends`` (arrays, by start, then rule; code
    points, end exclusive) and the ``values`` found.

    Null and empty texts have empty arrays, repeated rows each have their own, other columns are
    not read. A match of no more than its rule's ``least`` bytes minus one is dropped but still takes its place.
    """
    rules = tuple(rules)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = scanner(rules)
        for batch in slices(batches, "text"):
            column = whole(batch.column("text"))
            texts = [t.encode() for t in column.to_pylist()]
            kinds, starts, ends, values = [], [], [], []
            for data, spans in zip(texts, own.spans(texts), strict=True):
                spans = sorted(spans)
                values.append([data[s:e].decode() for s, _, e in spans])
                points = _code_points(data, spans)
                kinds.append([rules[r].kind for _, r, _ in points])
                starts.append([s for s, _, _ in points])
                ends.append([e for _, _, e in points])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(kinds, pa.list_(pa.string())),
                    pa.array(starts, pa.list_(pa.int64())),
                    pa.array(ends, pa.list_(pa.int64())),
                    pa.array(values, pa.list_(pa.string())),
                ],
                names=["key", "kinds", "starts", "ends", "values"],
            )

    kind = dict(docs.dtypes)[key]
    found = docs.selectExpr(f"`{key}` AS key", f"`{text}` AS text").mapInArrow(
        scan, f"key {kind}, kinds array<string>, starts array<bigint>, ends array<bigint>, values array<string>"
    )
    return found.withColumnRenamed("key", key)


def span_text(kinds: Sequence[str], starts: Sequence[int], ends: Sequence[int], only: Sequence[str] | None = None) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in zip(kinds, starts, ends, strict=True) if only is None or k in only)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


__all__ = ["Automaton", "BASE", "RULES", "Rule", "Scanner", "find_secrets", "scanner", "sha", "span_text"]
