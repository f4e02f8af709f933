"""Exact top-k search by inner product with pivot tables.

Distances to many pivots, computed once for each vector, bound its distance to a query from below: by the largest difference
of their distances to one pivot. With the norms that bounds the product from above. Candidates are evaluated in
the order of their bounds until no bound reaches the k-th best score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfspark.llm.frames import named

PIVOTS = 32
#: Vectors that pivots are chosen from: those whose id has the smallest hash.
SAMPLE = 2048
#: Candidates and queries that one task compares, about.
BLOCK, QUERIES = 16_384, 1024
#: Up to here products of whole numbers are exact as doubles.
EXACT = float(1 << 52)


def whole_steps(vectors: pa.Array, steps: float) -> np.ndarray:
    """floor(steps * x) as doubles, a row for each vector, short ones filled with 0."""
    lists = vectors.to_pylist()
    width = max((len(v) for v in lists), default=0)
    out = np.zeros((len(lists), width))
    for i, v in enumerate(lists):
        out[i, : len(v)] = v
    return np.floor(out * steps)


def choose_pivots(vectors: np.ndarray, count: int) -> np.ndarray:
    """Vectors far from each other: each the farthest from those before."""
    if not len(vectors):
        return vectors
    at = [0]
    near = ((vectors - vectors[0]) ** 2).sum(axis=1)
    while len(at) < min(count, len(vectors)):
        at.append(int(near.argmax()))
        near = np.minimum(near, ((vectors - vectors[at[-1]]) ** 2).sum(axis=1))
    return vectors[at]


def _wide(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] >= width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    width = max(vectors.shape[1], pivots.shape[1])
    a, b = _wide(vectors, width), _wide(pivots, width)
    square = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def products(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products, as whole numbers of 64 bits; beyond that the nearest such number."""
    if (np.abs(rows) @ np.abs(query)).max(initial=0.0) < EXACT:
        return (rows @ query).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(r, query, strict=True)) for r in rows]
    return np.array([max(-(1 << 63), min((1 << 63) - 1, x)) for x in exact], np.int64)


def best(
    query: np.ndarray, to_pivots: np.ndarray, own: int, ids: np.ndarray, rows: np.ndarray, squares: np.ndarray, table: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``k`` best rows but those with the query's own id, ties to smaller ids."""
    bound = np.zeros(len(rows))
    for p in range(table.shape[1]):
        np.maximum(bound, np.abs(table[:, p] - to_pivots[p]), out=bound)
    size = float((query**2).sum())
    # A margin far above the rounding of the distances, so no candidate is lost.
    upper = (size + squares - bound**2) / 2 + 1e-9 * (size + squares) + 1
    upper[ids == own] = -np.inf
    order = np.argsort(-upper, kind="stable")
    order = order[: len(order) - int((ids == own).sum())]
    found, scores, at, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 4 * k
    while at < len(order):
        if len(scores) >= k and upper[order[at]] < scores[k - 1]:
            break
        part = order[at : at + step]
        found = np.concatenate((found, ids[part]))
        scores = np.concatenate((scores, products(query, rows[part])))
        top = np.lexsort((found, -scores))[:k]
        found, scores = found[top], scores[top]
        at, step = at + step, 2 * step
    return found, scores


def top_products(
    vectors: DataFrame,
    queries: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 10,
    steps: float = 1024.0,
    pivots: int = PIVOTS,
    sample: int = SAMPLE,
    block: int = BLOCK,
    query_block: int = QUERIES,
) -> DataFrame:
    """For each row that ``queries`` picks its ``k`` best other rows: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``.

    Components count as floor(steps * x). A query's own row is every row with its id. Rows without id, vectors that are
    null or hold null, NaN or infinite components take no part; short vectors count as filled with 0. Ids that
    repeat are candidates as often as they occur, and queries too, each with its own ranks. Fewer than ``k``
    other rows give fewer results.

    Candidates and queries are dealt to blocks by the hash of their id, and every pair of blocks is one task, so
    none grows with the data. Pivots come from a bounded sample; they affect the work, not the result.
    """
    finite = F.forall(named(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.filter(named(key).isNotNull() & named(vector).isNotNull() & finite)
    rows = rows.select(named(key).cast("bigint").alias("id"), named(vector).alias("vector"), queries.alias("asks"))
    number, asking = rows.agg(F.count("*"), F.count(F.when(F.col("asks"), 1))).first()
    across, down = max(1, -(-number // block)), max(1, -(-asking // query_block))
    few = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").toArrow()
    chosen = choose_pivots(whole_steps(few.column("vector").combine_chunks(), steps), pivots)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = whole_steps(batch.column("vector"), steps)
            to = distances(own, chosen)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("asks"),
                    batch.column("row"),
                    pa.array(list(own), pa.list_(pa.float64())),
                    pa.array(list(to), pa.list_(pa.float64())),
                ],
                names=["id", "asks", "row", "vector", "to"],
            )

    measured = rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        measure, "id bigint, asks boolean, row bigint, vector array<double>, to array<double>"
    )
    spread = F.pmod(F.xxhash64("row", F.lit(7)), F.lit(across)).cast("int")
    lines = F.pmod(F.xxhash64("row", F.lit(11)), F.lit(down)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = measured.select("id", "vector", "to", spread.alias("a"), every(down).alias("b"))
    right = measured.filter("asks").select("id", "row", "vector", "to", every(across).alias("a"), lines.alias("b"))

    def compare(candidates: pa.Table, asked: pa.Table) -> pa.Table:
        def matrix(table: pa.Table, name: str) -> np.ndarray:
            return whole_steps(table.column(name).combine_chunks(), 1.0) if name == "vector" else _dense(table, name)

        ids = candidates.column("id").to_numpy()
        x, q = matrix(candidates, "vector"), matrix(asked, "vector")
        width = max(x.shape[1], q.shape[1])
        x, q = _wide(x, width), _wide(q, width)
        table, to = _dense(candidates, "to"), _dense(asked, "to")
        squares = (x**2).sum(axis=1)
        out: dict[str, list] = {"row": [], "query_id": [], "vec_id": [], "score": []}
        for i, (own, row) in enumerate(zip(asked.column("id").to_pylist(), asked.column("row").to_pylist(), strict=True)):
            if not len(ids):
                break
            found, scores = best(q[i], to[i], own, ids, x, squares, table, k)
            out["row"] += [row] * len(found)
            out["query_id"] += [own] * len(found)
            out["vec_id"] += found.tolist()
            out["score"] += scores.tolist()
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    found = (
        left.groupBy("a", "b")
        .cogroup(right.groupBy("a", "b"))
        .applyInArrow(compare, "row bigint, query_id bigint, vec_id bigint, score bigint")
    )
    rank = F.row_number().over(W.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    ranked = found.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _dense(table: pa.Table, name: str) -> np.ndarray:
    column = table.column(name).combine_chunks()
    rows = len(column)
    return column.flatten().to_numpy().reshape(rows, -1) if rows else np.zeros((0, 0))
