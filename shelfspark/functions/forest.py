"""NumPy kernels of the isolation forest: grow one small tree, walk rows through all trees."""

from __future__ import annotations

import numpy as np
import pandas as pd

NODE_COLUMNS = ["tree", "node", "feature", "threshold", "left", "right", "reach"]


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Expected path length of an unsuccessful search among n readings."""
    n = np.asarray(n, float)
    big = np.maximum(n, 3.0)
    harmonic = np.log(big - 1) + np.euler_gamma
    return np.where(n <= 1, 0.0, np.where(n <= 2, 1.0, 2 * harmonic - 2 * (big - 1) / big))


def grow_tree(x: np.ndarray, seed: int) -> list[tuple]:
    """Nodes (node, feature, threshold, left, right, reach); leaves have feature -1."""
    rng = np.random.default_rng(seed)
    limit = int(np.ceil(np.log2(max(len(x), 2))))
    nodes, waiting, last = [], [(0, np.arange(len(x)), 0)], 0
    while waiting:
        node, rows, depth = waiting.pop()
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        splittable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or not len(splittable):
            nodes.append((node, -1, 0.0, -1, -1, depth + float(average_path(len(rows)))))
            continue
        feature = int(rng.choice(splittable))
        threshold = float(rng.uniform(low[feature], high[feature]))
        goes_left = x[rows, feature] <= threshold
        left, right, last = last + 1, last + 2, last + 2
        nodes.append((node, feature, threshold, left, right, 0.0))
        waiting += [(left, rows[goes_left], depth + 1), (right, rows[~goes_left], depth + 1)]
    return nodes


def grow_group(sample: pd.DataFrame, features: list[str], seed: int) -> pd.DataFrame:
    tree = int(sample["tree"].iloc[0])
    x = sample.sort_values("draw")[features].to_numpy(float)
    grown = pd.DataFrame(grow_tree(x, seed + tree), columns=NODE_COLUMNS[1:])
    return grown.assign(tree=tree)[NODE_COLUMNS]


def pack(nodes: pd.DataFrame) -> list[tuple[np.ndarray, ...]]:
    """One tuple of node arrays per tree, indexed by node number."""
    trees = []
    for _, t in nodes.sort_values(["tree", "node"]).groupby("tree"):
        trees.append(tuple(t[c].to_numpy() for c in NODE_COLUMNS[2:]))
    return trees


def normality(x: np.ndarray, trees: list[tuple[np.ndarray, ...]], sample_size: int) -> np.ndarray:
    """Minus the anomaly score: -1 is most anomalous, 0 least."""
    reach = np.zeros(len(x))
    rows = np.arange(len(x))
    for feature, threshold, left, right, length in trees:
        at = np.zeros(len(x), int)
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                break
            goes_left = x[rows, np.maximum(f, 0)] <= threshold[at]
            at = np.where(inner, np.where(goes_left, left[at], right[at]), at)
        reach += length[at]
    return -np.power(2.0, -reach / len(trees) / float(average_path(sample_size)))
