"""Deterministic automata over bytes: compiled from patterns by subset construction and minimised.

Patterns know literals, ``\\xHH``, ``\\.`` and the like, classes, groups, ``(?i:...)``, ``|`` and the
repeats ``? * + {m} {m,} {m,n}``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BREAK = 0xFF  # stands between texts; in no UTF-8 text, so in no class


@dataclass
class _Nfa:
    empty: list[list[int]] = field(default_factory=list)
    moves: list[list[tuple[frozenset[int], int]]] = field(default_factory=list)

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1


class _Reader:
    """Pattern to a tree of ('set', bytes), ('seq', nodes), ('or', nodes), ('repeat', node, least, most)."""

    def __init__(self, pattern: str):
        self.text, self.at, self.either_case = pattern, 0, False

    def tree(self):
        node = self._or()
        if self.at != len(self.text):
            raise ValueError(f"unexpected {self.text[self.at]!r} in {self.text!r}")
        return node

    def _peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def _next(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def _or(self):
        branches = [self._seq()]
        while self._peek() == "|":
            self._next()
            branches.append(self._seq())
        return branches[0] if len(branches) == 1 else ("or", branches)

    def _seq(self):
        nodes = []
        while self._peek() not in ("", "|", ")"):
            nodes.append(self._repeat(self._atom()))
        return ("seq", nodes)

    def _repeat(self, node):
        while (c := self._peek()) and c in "?*+{":
            self._next()
            if c == "{":
                inside = self.text[self.at : self.text.index("}", self.at)]
                self.at += len(inside) + 1
                least, comma, most = inside.partition(",")
                node = ("repeat", node, int(least), int(most) if most else None if comma else int(least))
            else:
                node = ("repeat", node, int(c == "+"), 1 if c == "?" else None)
        return node

    def _atom(self):
        c = self._next()
        if c == "(":
            before = self.either_case
            if self.text.startswith("?i:", self.at):
                self.at, self.either_case = self.at + 3, True
            node = self._or()
            if self._peek() != ")":
                raise ValueError(f"unclosed group in {self.text!r}")
            self._next()
            self.either_case = before
            return node
        if c == "[":
            return ("set", self._cased(self._class()))
        return ("set", self._cased({self._byte(c)}))

    def _byte(self, c: str) -> int:
        if c == "\\":
            c = self._next()
            if c == "x":
                self.at += 2
                return int(self.text[self.at - 2 : self.at], 16)
        return ord(c)

    def _class(self) -> set[int]:
        out: set[int] = set()
        while self._peek() != "]":
            low = self._byte(self._next())
            if self._peek() == "-" and self.text[self.at + 1] != "]":
                self._next()
                out.update(range(low, self._byte(self._next()) + 1))
            else:
                out.add(low)
        self._next()
        return out

    def _cased(self, found: set[int]) -> frozenset[int]:
        if self.either_case:
            found = {b for c in found for b in (ord(chr(c).lower()), ord(chr(c).upper()))}
        return frozenset(found)


def _build(nfa: _Nfa, node, start: int, backwards: bool) -> int:
    """Adds the node's states after ``start``; returns the last one."""
    kind = node[0]
    if kind == "set":
        end = nfa.state()
        nfa.moves[start].append((node[1], end))
        return end
    if kind == "seq":
        for child in reversed(node[1]) if backwards else node[1]:
            start = _build(nfa, child, start, backwards)
        return start
    if kind == "or":
        end = nfa.state()
        for child in node[1]:
            nfa.empty[_build(nfa, child, start, backwards)].append(end)
        return end
    _, child, least, most = node
    for _ in range(least):
        start = _build(nfa, child, start, backwards)
    if most is None:
        loop, end = nfa.state(), nfa.state()
        nfa.empty[start].append(loop)
        nfa.empty[_build(nfa, child, loop, backwards)].append(loop)
        nfa.empty[loop].append(end)
        return end
    end = nfa.state()
    nfa.empty[start].append(end)
    for _ in range(most - least):
        start = _build(nfa, child, start, backwards)
        nfa.empty[start].append(end)
    return end


@dataclass
class Automaton:
    """``step[state, group[byte]]`` is the next state, 0 the first; ``accept[state]`` has a bit for each pattern."""

    group: np.ndarray
    step: np.ndarray
    accept: np.ndarray

    @property
    def dead(self) -> int:
        """The state that nothing leads out of, or -1."""
        own = (self.step == np.arange(len(self.step))[:, None]).all(axis=1) & (self.accept == 0)
        return int(own.argmax()) if own.any() else -1


def compile_patterns(patterns: list[str], backwards: bool = False, anywhere: bool = False) -> Automaton:
    """One automaton for all patterns. ``backwards`` reads matches from their end; ``anywhere`` lets a match
    begin at every byte, so a bit of ``accept`` says that a match of that pattern ends (backwards:
    begins) here."""
    nfa = _Nfa()
    first, ends = nfa.state(), {}
    for bit, pattern in enumerate(patterns):
        own = nfa.state()
        nfa.empty[first].append(own)
        ends[_build(nfa, _Reader(pattern).tree(), own, backwards)] = 1 << bit

    sets = sorted({s for moves in nfa.moves for s, _ in moves}, key=sorted)
    marks: dict[tuple, int] = {}
    group = np.array([marks.setdefault(tuple(b in s for s in sets), len(marks)) for b in range(256)])
    member = {g: b for b, g in reversed(list(enumerate(group.tolist())))}

    def closure(states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for s in nfa.empty[todo.pop()]:
                if s not in found:
                    found.add(s)
                    todo.append(s)
        return frozenset(s for s in found if nfa.moves[s] or s in ends)

    begin = closure([first])
    number, todo, rows = {begin: 0}, [begin], []
    for current in todo:
        row = []
        for g in range(len(marks)):
            moved = {t for s in current for chars, t in nfa.moves[s] if member[g] in chars}
            after = closure(moved) | begin if anywhere else closure(moved)
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            row.append(number[after])
        rows.append(row)
    accept = np.array([sum(ends.get(s, 0) for s in states) for states in todo])
    return _minimised(Automaton(group.astype(np.uint8), np.array(rows), accept))


def _minimised(a: Automaton) -> Automaton:
    """Refines the classes of states with equal ``accept`` until each class steps as one."""
    block = np.unique(a.accept, return_inverse=True)[1]
    while True:
        seen = np.concatenate([block[:, None], block[a.step]], axis=1)
        _, at, finer = np.unique(seen, axis=0, return_index=True, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    order = np.argsort(at != at[finer[0]], kind="stable")  # the first state stays 0
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    chosen = at[order]
    return Automaton(a.group, rank[finer][a.step[chosen]], a.accept[chosen])


def marks(a: Automaton, data: np.ndarray, lanes: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Positions after whose byte the automaton accepts, and what it accepts there, in one pass.

    The bytes are dealt to lanes that step together, each from the first state. A lane that should have begun
    in another state is run again until both runs are in the same state, mostly a few bytes.
    """
    size = len(data)
    lanes = max(1, min(lanes, size // 64))
    steps = -(-size // lanes) if size else 0
    padded = np.full(lanes * steps, BREAK, np.uint8)
    padded[:size] = data
    groups = np.ascontiguousarray(a.group[padded].reshape(lanes, steps).T)
    width = a.step.shape[1]
    table = (a.step * width).reshape(-1)
    visited = np.empty((steps, lanes), np.int64 if len(table) > 1 << 31 else np.int32)
    state = np.zeros(lanes, np.int64)
    for i in range(steps):
        state = table.take(state + groups[i])
        visited[i] = state
    for lane in range(1, lanes):
        now = int(visited[-1, lane - 1])
        if now:
            for i in range(steps):
                now = int(table[now + int(groups[i, lane])])
                if visited[i, lane] == now:
                    break
                visited[i, lane] = now
    found = np.repeat(a.accept, width)[visited.T.reshape(-1)[:size]] if size else np.zeros(0, np.int64)
    at = np.flatnonzero(found)
    return at, found[at]
