"""Gradient-boosted regressors by histograms.

Features are cut once into 255 bins at their quantiles, with a bin of its own for missing readings, and written as one byte a
feature. From then on a round needs sums of gradients and curvatures per node, feature and bin only: each task sums its rows,
Spark adds the sums of the tasks, and the driver, which sees nothing but these sums (their number depends on nodes and
features, not on rows), chooses the splits. Of two siblings only the smaller one is summed; the other is what is left of the
parent. The nodes of one depth are summed in one pass. Rows that fit one task are not dealt out: it sums and grows by itself, with the
same code, and sends back trees. Of the deep model only nodes that can still be among the best are
opened, which gives the same tree as opening the best leaf each time.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from typing import Literal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.functions import histograms as H
from shelfspark.session import settle

# The executors need NumPy, not this package.
cloudpickle.register_pickle_by_value(H)

PREDICTION = "predicted_replenishment_signal"
# Defaults of the two contrast models: size of a tree, trees, learning rate, early stopping; penalty on leaves, rows a leaf needs.
PRESETS = {
    "deep": {
        "max_depth": 8, "max_leaves": 31, "n_trees": 300, "learning_rate": 0.05, "early_stop": True, "penalty": 0.0, "least_rows": 20, "importance": "splits",
    },
    "shallow": {
        "max_depth": 6, "max_leaves": None, "n_trees": 300, "learning_rate": 0.05, "early_stop": False, "penalty": 1.0, "least_rows": 1, "importance": "gain",
    },
}

# Early stopping waits so many rounds for a lower validation error.
PATIENCE = 30
#: Rows a task sums.
TASK_ROWS = 50_000
#: Trees that tasks apply anew before scores are written again.
UNWRITTEN = 10
#: Bins (rows times features, a byte each) up to which one task holds all rows and grows the trees alone. A job for each depth takes
#: longer than the sums of so few rows.
ONE_TASK = 16_000_000
#: Trees that such a task grows before the driver looks whether to stop.
TREES_AT_ONCE = 50
NODE_COLUMNS = ["tree", "node", "feature", "threshold", "missing_left", "left", "right", "value", "gain"]
NODES = "tree int, node int, feature int, threshold double, missing_left boolean, left int, right int, value double, gain double"


def rounds_kept(errors: Sequence[float], patience: int = PATIENCE) -> int:
    """Rounds up to the lowest error that is met before ``patience`` rounds pass without a lower one."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def bin_edges(rows: DataFrame, features: Sequence[str], bins: int = H.MISSING) -> list[np.ndarray]:
    """Per feature the ascending upper edges of its bins but the last: values, each once, between quantile ranks in equal steps."""
    ranks = [i / bins for i in range(1, bins)]
    found = rows.agg(*(F.percentile_approx(F.col(c).cast("double"), ranks, 10_000).alias(f"q{i}") for i, c in enumerate(features))).first()
    return [np.unique(np.array([] if q is None else q, float)) for q in found]


def _binned(rows: DataFrame, features: Sequence[str], edges: list[np.ndarray], target: str, base: float, val: str) -> DataFrame:
    """One byte a feature in ``bins``; ``y``, ``score`` (the model so far) and ``val``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.empty((batch.num_rows, len(edges)), np.uint8)
            for i, own in enumerate(edges):
                x = batch.column(i).to_numpy(zero_copy_only=False).astype(float)
                out[:, i] = np.where(np.isnan(x), H.MISSING, np.searchsorted(own, x))
            packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(len(edges)), batch.num_rows, [None, pa.py_buffer(out.tobytes())])
            score = pa.array(np.full(batch.num_rows, base))
            yield pa.RecordBatch.from_arrays(
                [packed.cast(pa.binary()), batch.column("y"), score, batch.column("val")], names=["bins", "y", "score", "val"]
            )

    columns = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    return rows.select(*columns, F.col(target).cast("double").alias("y"), F.col(val).alias("val")).mapInArrow(
        cut, "bins binary, y double, score double, val boolean"
    )


def _advanced(state: DataFrame, trees: list[H.Tree], features: int) -> DataFrame:
    """``state`` with ``trees`` in its scores."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, _, score, _ = H.unpacked(batch, features)
            yield batch.set_column(batch.schema.get_field_index("score"), "score", pa.array(H.grown(score, trees, bins)))

    return state.mapInArrow(apply, state.schema)


def _sums(state: DataFrame, tasks: int, trees: list[H.Tree], tree: H.Tree, wanted: list[int], features: int) -> tuple[np.ndarray, float]:
    """Sums per wanted node of ``tree``, feature and bin over the training rows, and the mean squared validation error of
    the scores with ``trees``. A task sends a row for each node, whatever its rows; the rows of a node are added by Spark."""
    shape = (2, features, H.BINS)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, squares = np.zeros((len(wanted), *shape)), np.zeros(2)
        for batch in batches:
            bins, y, score, val = H.unpacked(batch, features)
            error = H.grown(score, trees, bins) - y
            squares += (error[val] ** 2).sum(), val.sum()
            own = bins[~val]
            total += H.node_sums(own, error[~val], H.leaves(tree, own), wanted)
        blobs = [squares.tobytes(), *(x.tobytes() for x in total)]
        slots = pa.array(np.arange(-1, len(wanted), dtype=np.int32))
        yield pa.RecordBatch.from_arrays([slots, pa.array(blobs, pa.binary())], names=["slot", "sums"])

    def added(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py()) for x in table.column("sums"))
        return table.slice(0, 1).set_column(1, "sums", pa.array([total.tobytes()], pa.binary()))

    found = state.mapInArrow(summed, "slot int, sums binary")
    if tasks > 1:
        found = found.groupBy("slot").applyInArrow(added, "slot int, sums binary")
    by_slot = {r["slot"]: np.frombuffer(r["sums"]) for r in found.collect()}
    squares, rows = by_slot.get(-1, np.zeros(2))
    sums = np.array([by_slot[i] for i in range(len(wanted))]).reshape(len(wanted), *shape)
    return sums, squares / rows if rows else float("nan")


def _rounds(state: DataFrame, tasks: int, features: int, settings: dict, errors: bool) -> Iterator[tuple[H.Tree | None, float]]:
    """The next tree and the validation error before it, round after round, and at last the error after all trees. Every depth
    of a tree is a pass of all tasks over their rows; scores are written every ten trees."""
    fresh: list[H.Tree] = []
    for i in range(settings["n_trees"] + 1):
        if len(fresh) >= UNWRITTEN:
            state, fresh = settle(_advanced(state, fresh, features), "scores"), []
        if i == settings["n_trees"]:
            yield None, _sums(state, tasks, fresh, H.Tree.stump(), [], features)[1] if errors else 0.0
        else:
            grown = H.grow_tree(lambda tree, wanted: _sums(state, tasks, fresh, tree, wanted, features), settings)  # noqa: B023
            fresh = [*fresh, grown[0]]
            yield grown


def _rounds_of_one_task(state: DataFrame, features: int, settings: dict, errors: bool) -> Iterator[tuple[H.Tree | None, float]]:
    """``_rounds`` of rows that one task can hold: it grows many trees in one pass, without a job for each depth."""
    trees: list[H.Tree] = []
    while True:
        left = settings["n_trees"] - len(trees)
        most = min(left, TREES_AT_ONCE) if errors else left

        def run(batches: Iterator[pa.RecordBatch], before: tuple[H.Tree, ...] = tuple(trees), most: int = most) -> Iterator[pa.RecordBatch]:
            blocks = [H.Block(*H.unpacked(batch, features), before) for batch in batches]
            found = [pickle.dumps(x) for x in H.rounds(blocks, features, settings, most)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(found)), pa.int32()), pa.array(found, pa.binary())], names=["nth", "found"])

        done = sorted(state.coalesce(1).mapInArrow(run, "nth int, found binary").collect())
        *grown, (_, last) = (pickle.loads(r["found"]) for r in done)
        for tree, error in grown:
            trees.append(H.Tree(*tree))
            yield trees[-1], error
        if most == left:
            yield None, last
            return


@dataclass
class DemandRegressor:
    """Fit, predict and explain one boosted model of squared error. ``params`` override the preset.

    ``deep`` grows its best leaf first and stops when 30 rounds on the validation rows bring no lower error; ``shallow`` grows
    by depth with a penalty on leaf values. Missing features are allowed in both: each split sends them to the side of larger
    gain. Rows without a target are left out. ``nodes`` are the fitted trees, a row for each node.
    """

    preset: Literal["deep", "shallow"] = "deep"
    params: dict = field(default_factory=dict)
    target: str = "replenishment_signal"
    features: list[str] = field(default_factory=list)
    base: float = 0.0
    nodes: pd.DataFrame | None = None
    val_errors: list[float] = field(default_factory=list)

    def settings(self) -> dict:
        return {**PRESETS[self.preset], **self.params}

    def fit(self, train: DataFrame, features: Sequence[str], val: DataFrame | None = None) -> DemandRegressor:
        """Grow trees until early stopping on ``val`` or the number of trees."""
        s = self.settings()
        self.features = list(features)
        present = F.col(self.target).isNotNull()
        rows = train.where(present).select(*self.features, self.target, F.lit(False).alias("_val"))
        count, mean = rows.agg(F.count("*"), F.avg(F.col(self.target).cast("double"))).first()
        self.base = float(mean or 0.0)
        edges = bin_edges(rows, self.features)
        if val is not None:
            rows = rows.unionByName(val.where(present).select(*self.features, self.target, F.lit(True).alias("_val")))
            count += val.where(present).count()
        state = _binned(rows, self.features, edges, self.target, self.base, "_val")
        stop = s["early_stop"] and val is not None
        if count * len(edges) <= ONE_TASK:
            rounds = _rounds_of_one_task(settle(state.repartition(1), "binned"), len(edges), s, stop)
        else:
            tasks = max(1, -(-count // TASK_ROWS))
            rounds = _rounds(settle(state.repartition(tasks), "binned"), tasks, len(edges), s, stop)
        trees: list[H.Tree] = []
        self.val_errors = []
        for i, (tree, error) in enumerate(rounds):
            if i and stop:
                self.val_errors.append(error)
                if len(self.val_errors) - rounds_kept(self.val_errors) >= PATIENCE:
                    break
            if tree is not None:
                trees.append(tree)
        if stop:
            trees = trees[: rounds_kept(self.val_errors)]
        self.nodes = pd.DataFrame(
            [
                (t, n, tree.feature[n], _edge(edges, tree, n), tree.missing_left[n], tree.left[n], tree.right[n], tree.value[n], tree.gain[n])
                for t, tree in enumerate(trees)
                for n in range(len(tree.feature))
            ],
            columns=NODE_COLUMNS,
        )
        return self

    def _fitted(self) -> pd.DataFrame:
        if self.nodes is None:
            raise RuntimeError("fit the model before using it")
        return self.nodes

    @property
    def trees(self) -> int:
        """Trees that the model keeps."""
        return self._fitted()["tree"].nunique()

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with the prediction. The trees (a few thousand nodes) are sent to the executors once."""
        nodes = self._fitted()
        missing = [c for c in self.features if c not in df.columns]
        if missing:
            raise ValueError(f"missing feature columns: {', '.join(missing)}")
        packed = [tuple(t[c].to_numpy() for c in NODE_COLUMNS[2:-1]) for _, t in nodes.groupby("tree")]
        shipped, base = df.sparkSession.sparkContext.broadcast(packed), self.base

        @F.pandas_udf("double")
        def predicted(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(float) for c in columns])
            total = np.full(len(x), base)
            for feature, threshold, missing_left, left, right, value in shipped.value:
                at, rows = np.zeros(len(x), int), np.arange(len(x))
                while len(rows):
                    rows = rows[feature[at[rows]] >= 0]
                    own = at[rows]
                    seen = x[rows, feature[own]]
                    goes_left = np.where(np.isnan(seen), missing_left[own], seen <= threshold[own])
                    at[rows] = np.where(goes_left, left[own], right[own])
                total += value[at]
            return pd.Series(total)

        return df.withColumn(PREDICTION, predicted(*(F.col(c).cast("double") for c in self.features)))

    def feature_importance(self, top: int | None = None, kind: str | None = None) -> DataFrame:
        """(feature, importance), most important first, in sum 1: shares of the splits or of their gain, as the preset has it."""
        kind = kind or self.settings()["importance"]
        inner = self._fitted().query("feature >= 0")
        weight = inner["gain"] if kind == "gain" else inner["gain"] * 0 + 1
        shares = weight.groupby(inner["feature"]).sum() / max(weight.sum(), 1e-300)
        rows = [(c, float(shares.get(i, 0.0))) for i, c in enumerate(self.features)]
        table = SparkSession.active().createDataFrame(rows, "feature string, importance double")
        ordered = table.orderBy(F.desc("importance"), "feature")
        return ordered if top is None else ordered.limit(top)

    def save(self, path: str) -> None:
        """The nodes as a table and the rest as a document beside them."""
        spark = SparkSession.active()
        spark.createDataFrame(self._fitted(), NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        about = json.dumps({"preset": self.preset, "params": self.params, "target": self.target, "features": self.features, "base": self.base})
        spark.createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")

    @classmethod
    def load(cls, path: str) -> DemandRegressor:
        spark = SparkSession.active()
        about = json.loads(spark.read.text(f"{path}/about").first()["value"])
        nodes = spark.read.schema(NODES).parquet(f"{path}/nodes").orderBy("tree", "node").toPandas()
        return cls(**about, nodes=nodes)


def _edge(edges: list[np.ndarray], tree: H.Tree, node: int) -> float:
    """The largest value that goes left; above all edges every known value does."""
    own = edges[tree.feature[node]] if tree.feature[node] >= 0 else np.zeros(0)
    return float(own[tree.bin[node]]) if tree.bin[node] < len(own) else float("inf")
