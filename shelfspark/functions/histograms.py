"""NumPy kernels of histogram boosting: sums per node, feature and bin of a block of rows, the best split of such sums, and the growth
of a tree from sums, wherever they come from."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import astuple, dataclass, field

import numpy as np
import pyarrow as pa

#: Bins of a feature; the last one holds missing readings.
BINS = 256
MISSING = BINS - 1


@dataclass
class Tree:
    """Nodes by number, 0 is the root. A leaf has feature -1. Bins up to ``bin`` go left, missing ones where ``missing_left`` says."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    @classmethod
    def stump(cls) -> Tree:
        """A tree of one leaf."""
        tree = cls()
        tree.add(0.0)
        return tree

    def add(self, value: float) -> int:
        for column, x in (
            (self.feature, -1), (self.bin, 0), (self.missing_left, False), (self.left, -1), (self.right, -1), (self.value, value), (self.gain, 0.0)
        ):
            column.append(x)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, at: int, missing_left: bool, gain: float, values: tuple[float, float]) -> tuple[int, int]:
        self.feature[node], self.bin[node], self.missing_left[node], self.gain[node] = feature, at, missing_left, gain
        self.left[node], self.right[node] = self.add(values[0]), self.add(values[1])
        return self.left[node], self.right[node]


def unpacked(batch: pa.RecordBatch, features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bins (rows by features), target, score and whether a row is for validation."""
    packed = batch.column("bins").cast(pa.binary(features))
    bins = np.frombuffer(packed.buffers()[1], np.uint8)[packed.offset * features :][: len(packed) * features]
    y, score, val = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "score", "val"))
    return bins.reshape(-1, features), y, score, val.astype(bool)


def leaves(tree: Tree, bins: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """The leaf that each row ends in, on the way from the root or from the nodes of ``start``."""
    feature, at = np.array(tree.feature), np.array(tree.bin)
    lost, left, right = np.array(tree.missing_left), np.array(tree.left), np.array(tree.right)
    node, rows = np.zeros(len(bins), np.int64) if start is None else start.copy(), np.arange(len(bins))
    while len(rows):
        own = node[rows]
        inner = feature[own] >= 0
        rows, own = rows[inner], own[inner]
        found = bins[rows, feature[own]]
        goes_left = np.where(found == MISSING, lost[own], found <= at[own])
        node[rows] = np.where(goes_left, left[own], right[own])
    return node


def grown(score: np.ndarray, trees: list[Tree], bins: np.ndarray) -> np.ndarray:
    for tree in trees:
        score = score + np.array(tree.value)[leaves(tree, bins)]
    return score


def node_sums(bins: np.ndarray, gradient: np.ndarray, node: np.ndarray, wanted: list[int]) -> np.ndarray:
    """Per wanted node the sums of gradients and of curvatures (1 for each row under squared error) by feature and bin."""
    features = bins.shape[1]
    place = np.full(max([int(node.max(initial=0)), *wanted]) + 1, -1)
    place[wanted] = np.arange(len(wanted))
    slot = place[node]
    own = slot >= 0
    cell = ((slot[own, None] * 2 * features + np.arange(features)) * BINS + bins[own]).ravel()
    size = len(wanted) * 2 * features * BINS
    sums = np.bincount(cell, np.repeat(gradient[own], features), size)
    sums += np.bincount(cell + features * BINS, minlength=size)
    return sums.reshape(len(wanted), 2, features, BINS)


@dataclass
class Split:
    gain: float
    feature: int
    bin: int
    missing_left: bool
    left: tuple[float, float]
    right: tuple[float, float]


def best_split(sums: np.ndarray, penalty: float, least_rows: int) -> Split | None:
    """The split of largest gain of one node's (2, features, bins) sums, missing readings on the better side; None without any."""
    whole = sums[:, 0].sum(axis=1)
    known, lost = sums[:, :, :MISSING].cumsum(axis=2), sums[:, :, MISSING:]
    best = None
    for missing_left in (False, True):
        left = known + lost if missing_left else known
        right = whole[:, None, None] - left
        gain = left[0] ** 2 / np.maximum(left[1] + penalty, 1e-12) + right[0] ** 2 / np.maximum(right[1] + penalty, 1e-12)
        gain = np.where((left[1] >= least_rows) & (right[1] >= least_rows), gain, -np.inf)
        f, b = np.unravel_index(np.argmax(gain), gain.shape)
        found = float(gain[f, b] - whole[0] ** 2 / max(whole[1] + penalty, 1e-12))
        if np.isfinite(found) and found > 1e-9 and (best is None or found > best.gain * (1 + 1e-12)):
            sides = [(float(x[0, f, b]), float(x[1, f, b])) for x in (left, right)]
            best = Split(found, int(f), int(b), missing_left, *sides)
    return best


@dataclass
class Open:
    """A node that can be split: its best split and the smallest gain on the way to it."""

    split: Split
    way: float
    depth: int
    sums: np.ndarray | None


def _leaf(side: tuple[float, float], settings: dict) -> float:
    return -settings["learning_rate"] * side[0] / max(side[1] + settings["penalty"], 1e-12)


def grow_tree(sums_of: Callable[[Tree, list[int]], tuple[np.ndarray, float]], settings: dict) -> tuple[Tree, float]:
    """The next tree and the validation error before it. ``sums_of`` has the sums of the wanted nodes of a tree, and that error.

    Depth by depth, every node is opened that can be among the ``max_leaves`` - 1 best: those splits that are largest by the
    smallest gain on the way to them are just those that best-first growth would choose.
    """
    tree, most, root = Tree.stump(), settings["max_leaves"], 0
    sums, error = sums_of(tree, [root])
    known: dict[int, Open] = {}

    def look(node: int, own: np.ndarray, depth: int, way: float) -> None:
        split = best_split(own, settings["penalty"], settings["least_rows"])
        if split is not None:
            known[node] = Open(split, min(way, split.gain), depth, own)

    look(root, sums[0], 0, float("inf"))
    fresh = list(known)
    while fresh:
        ranked = sorted(known, key=lambda n: -known[n].way)
        able = set(ranked if most is None else ranked[: most - 1])
        born: list[tuple[int, int, int]] = []  # parent, smaller and larger child
        for node in fresh:
            if node in able:
                o = known[node]
                s = o.split
                left, right = tree.split(node, s.feature, s.bin, s.missing_left, s.gain, (_leaf(s.left, settings), _leaf(s.right, settings)))
                if o.depth + 1 < settings["max_depth"]:
                    born.append((node, *((left, right) if s.left[1] <= s.right[1] else (right, left))))
        fresh = []
        if born:
            sums, _ = sums_of(tree, [small for _, small, _ in born])
            before = set(known)
            for i, (parent, small, large) in enumerate(born):
                o = known[parent]
                look(small, sums[i], o.depth + 1, o.way)
                look(large, o.sums - sums[i], o.depth + 1, o.way)
            fresh = [n for n in known if n not in before]
        for node, o in known.items():
            if node not in fresh:
                o.sums = None
    return _pruned(tree, known, most), error


def _pruned(tree: Tree, known: dict[int, Open], most: int | None) -> Tree:
    """The tree that best-first growth to ``most`` leaves gives: nodes that it does not split become leaves."""
    out, size = Tree(), 1
    waiting: list[tuple[float, int, int]] = []

    def found(node: int) -> int:
        at = out.add(tree.value[node])
        if tree.feature[node] >= 0:
            heapq.heappush(waiting, (-known[node].split.gain, node, at))
        return at

    found(0)
    while waiting and (most is None or size < most):
        _, node, at = heapq.heappop(waiting)
        out.feature[at], out.bin[at], out.missing_left[at], out.gain[at] = tree.feature[node], tree.bin[node], tree.missing_left[node], tree.gain[node]
        out.left[at], out.right[at] = found(tree.left[node]), found(tree.right[node])
        size += 1
    return out


class Block:
    """Some rows in memory: bins, target and score of training and of validation rows."""

    def __init__(self, bins: np.ndarray, y: np.ndarray, score: np.ndarray, val: np.ndarray, trees: tuple[Tree, ...] = ()):
        score = grown(score, [*trees], bins)
        self.sides = [[bins[x], y[x], score[x]] for x in (~val, val)]
        self.node = np.zeros(0, np.int64)

    def add(self, tree: Tree) -> None:
        for side in self.sides:
            side[2] = grown(side[2], [tree], side[0])

    def sums(self, tree: Tree, wanted: list[int]) -> np.ndarray:
        bins, y, score = self.sides[0]
        # The tree only grows by a depth between two calls.
        self.node = leaves(tree, bins, None if wanted == [0] else self.node)
        return node_sums(bins, score - y, self.node, wanted)

    def squares(self) -> tuple[float, int]:
        _, y, score = self.sides[1]
        return ((score - y) ** 2).sum(), len(y)


def rounds(blocks: list[Block], features: int, settings: dict, most: int) -> Iterator[tuple[tuple | None, float]]:
    """``most`` trees as tuples of their columns, each with the validation error before it, and at last the error after them."""

    def error() -> float:
        squares, rows = (sum(x) for x in zip((0.0, 0), *(b.squares() for b in blocks), strict=True))
        return squares / rows if rows else float("nan")

    for _ in range(most):
        before = error()

        def sums_of(tree: Tree, wanted: list[int], before: float = before) -> tuple[np.ndarray, float]:
            return sum((b.sums(tree, wanted) for b in blocks), np.zeros((len(wanted), 2, features, BINS))), before

        tree, _ = grow_tree(sums_of, settings)
        for block in blocks:
            block.add(tree)
        yield astuple(tree), before
    yield None, error()
