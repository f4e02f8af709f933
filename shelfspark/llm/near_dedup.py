"""Near-duplicates by ProbMinHash signatures, banding and exact verification.

Texts with the same words are one node, so copies cost nothing more. Nodes that share a band are candidates. Not all
pairs of a bucket are looked at: links are wanted only for classes, so pairs that are already in one class are
skipped. Star rounds compare one member of each class with the best connected node of its buckets, which is
near the middle of a group of copies. A node's buckets stay in one row with its class, which a round rewrites once. What is then still apart is described by its differences from the best connected
node of the bucket, which bounds the similarity of every pair exactly (see ``_apart``); pairs that the bound allows
are compared. So every candidate pair is compared, excluded by its bound or already in one class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.batches import given_back, slices
from shelfspark.llm.frames import fresh, named
from shelfspark.llm.shingles import band_keys, probability_jaccard, shingles, signatures, weights
from shelfspark.session import settle

WORDS = 5
SIMILAR = 0.8
#: A pair of similarity 0.8 shares one of 20 bands of 4 registers with probability 0.99997.
BANDS, BAND_ROWS = 20, 4
STAR_ROUNDS = 2
#: A shingle of at most so many nodes that are still apart is looked up pair by pair; this sets the work, not the result.
FEW = 8
#: Bytes of text that are cut into shingles at a time; the arrays that this takes are some fifty times as large.
CUT_BYTES = 1 << 20


def signature_table(docs: DataFrame, key: str, text: str, words: int, bands: int, band_rows: int) -> DataFrame:
    """Per row ``key``, ``row`` (position in the scan), ``node`` (digest of the words) and ``bands``, empty without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given_back(slices(batches, "text", CUT_BYTES)):
            hashes, counts, offsets, digests = shingles(batch.column("text"), words)
            keys = band_keys(signatures(hashes, weights(counts), offsets, bands * band_rows), bands)
            some = np.diff(offsets) > 0
            ends = np.concatenate(([0], np.cumsum(some * bands))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[some].reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("row"), pa.array(digests, pa.binary()), lists],
                names=["key", "row", "node", "bands"],
            )

    rows = docs.select(named(key).cast("bigint").alias("key"), F.monotonically_increasing_id().alias("row"), named(text).alias("text"))
    return rows.mapInArrow(sign, "key bigint, row bigint, node binary, bands array<bigint>")


def _shingle_table(docs: DataFrame, wanted: DataFrame, text: str, words: int) -> DataFrame:
    """Per node of ``wanted`` (``node``, ``row`` of one of its texts) the shingles and their weights, as bytes, the number
    of shingles, the sum and the largest of the weights."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given_back(slices(batches, "text", CUT_BYTES)):
            hashes, counts, offsets, _ = shingles(batch.column("text"), words)
            own = weights(counts).astype(np.float32)
            pairs = list(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    pa.array([hashes[a:b].astype("<u8").tobytes() for a, b in pairs], pa.binary()),
                    # Most texts repeat no shingle: no weights then.
                    pa.array([own[a:b].astype("<f4").tobytes() if (own[a:b] > 1).any() else b"" for a, b in pairs], pa.binary()),
                    pa.array([b - a for a, b in pairs], pa.int64()),
                    pa.array([float(own[a:b].sum(dtype=float)) for a, b in pairs]),
                    pa.array([float(own[a:b].max(initial=1)) for a, b in pairs]),
                ],
                names=["node", "shingles", "weights", "size", "weight", "top"],
            )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), named(text).alias("text"))
    # Texts are dealt out by row whatever the number of wanted rows, so that the plan is the same at every size.
    return rows.join(wanted.hint("merge"), "row").select("node", "text").mapInArrow(
        cut, "node binary, shingles binary, weights binary, size bigint, weight double, top double"
    )


def _verified(pairs: DataFrame, table: DataFrame, least: float) -> DataFrame:
    """The pairs (``a``, ``b`` and any other columns) whose exact similarity is ``least`` or more."""
    rest = [c for c in pairs.columns if c not in ("a", "b")]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given_back(batches):
            columns = [batch.column(c) for c in ("shingles_a", "weights_a", "shingles_b", "weights_b")]
            keep = []
            for i in range(batch.num_rows):
                a, wa, b, wb = (c[i].as_py() for c in columns)
                x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
                wx = np.frombuffer(wa, "<f4") if wa else np.ones(len(x))
                wy = np.frombuffer(wb, "<f4") if wb else np.ones(len(y))
                keep.append(probability_jaccard(x, wx, y, wy) >= least)
            yield batch.select(["a", "b", *rest]).filter(pa.array(keep, pa.bool_()))

    def side(x: str) -> DataFrame:
        return table.select(F.col("node").alias(x), F.col("shingles").alias(f"shingles_{x}"), F.col("weights").alias(f"weights_{x}"))

    kinds = dict(pairs.dtypes)
    shape = ", ".join(f"{c} {kinds[c]}" for c in ("a", "b", *rest))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(check, shape)


def _differences(held: DataFrame) -> DataFrame:
    """Per row of ``held`` (``ref``, ``ref_label``, ``node``, ``label``, ``shingles``, ``weight``, ``top``, ``ref_shingles``) the
    shingles that only one of the two has, and one more row that has ``ref_label``, ``weight`` and ``top``; its ``shingle`` is no
    shingle, but spreads these rows."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given_back(batches):
            for ref, ref_label, node, label, own, weight, top, its in zip(*batch.columns, strict=True):
                found = np.setxor1d(np.frombuffer(own.as_py(), "<i8"), np.frombuffer(its.as_py(), "<i8"), assume_unique=True)
                same = [pa.array([x.as_py()] * (len(found) + 1), pa.binary()) for x in (ref, node, label)]
                once = [pa.array([None] * len(found) + [x.as_py()], x.type) for x in (ref_label, weight, top)]
                shingle = np.append(found, np.frombuffer(node.as_py(), "<i8", 1))
                yield pa.RecordBatch.from_arrays(
                    [*same, pa.array(shingle), *once], names=["ref", "node", "label", "shingle", "ref_label", "weight", "top"]
                )

    columns = held.select("ref", "ref_label", "node", "label", "shingles", "weight", "top", "ref_shingles")
    return columns.mapInArrow(
        spread, "ref binary, node binary, label binary, shingle bigint, ref_label binary, weight double, top double"
    )


def _able(similar: float, differ: Column) -> Column:
    """Can the columns' two nodes, the second one's with ``_b``, be similar if at least ``differ`` shingles are in one of them only.

    Of similarity s, weights W in sum and R at most: every term of the similarity that belongs to a common shingle is at most
    its weight by W plus the other text's own weights divided by R. So the weights that only one text has are together
    (1 - s) / (1 + s / R) times both sums at most, and every weight is 1 or more. For plain sets this is Jaccard's own bound.
    """
    top = F.greatest("top", "top_b")
    return differ <= (1 - similar) / (1 + similar / top) * (F.col("weight") + F.col("weight_b")) + 1e-6


def _apart(placed: DataFrame, mixed: DataFrame, table: DataFrame, similar: float) -> DataFrame:
    """Pairs (``a``, ``b``, ``x``, ``y``) of nodes in one bucket, but not in one class, that can be similar. ``mixed`` has the
    buckets of several classes, each with its best connected node.

    The nodes of a bucket are described by their differences from its best connected node: copies of one text have most
    shingles in common, and two texts differ in just those shingles in which one of them, but not both, differs from a third.
    Differences that only FEW of these nodes have, or the nodes of one class alone, are rare. Those shared are counted
    pair by pair. Without a rare difference in common only a node with few rare ones can be a partner. With the
    frequent differences, a list for each node, it is known exactly in how many shingles two texts differ, before they are
    fetched: of plain sets only the similar pairs are left.
    """
    refs = mixed.select("band", F.col("lead.node").alias("ref"), F.col("lead.label").alias("ref_label"))
    members = placed.join(refs, "band").select("ref", "ref_label", "node", "label").distinct()
    its = table.select(F.col("node").alias("ref"), F.col("shingles").alias("ref_shingles"))
    held = members.join(table.drop("size"), "node").join(its, "ref")
    rows = settle(_differences(held), "differences")
    of_shingle = F.col("weight").isNull()
    held_by = rows.filter(of_shingle).groupBy("ref", "shingle")
    held_by = held_by.agg(F.count("*").alias("n"), (F.min("label") == F.max("label")).alias("one_class"))
    few = settle(held_by.filter((F.col("n") <= FEW) | F.col("one_class")).select("ref", "shingle", "one_class"), "few")
    # Partners are looked up by their number of rare differences, in steps of a sixteenth of what is possible.
    most = F.max(2 * (1 - similar) / (1 + similar / F.col("top")) * F.col("weight") / similar)
    steps = rows.filter(~of_shingle).groupBy("ref").agg(
        F.ceil(F.greatest(most / 16, F.lit(1.0))).alias("step"), F.max("top").alias("most_top"), F.max("weight").alias("most_weight")
    )
    steps = settle(steps, "steps")
    marked = rows.join(few, ["ref", "shingle"], "left").withColumn("one_class", F.when(of_shingle, F.col("one_class")))
    rows = settle(marked, "marked")
    frequent = F.collect_list(F.when(of_shingle & F.col("one_class").isNull(), F.col("shingle"))).alias("frequent")
    once = [F.max(c).alias(c) for c in ("ref_label", "weight", "top")]
    own = rows.groupBy("ref", "node", "label").agg(F.count("one_class").alias("rare"), frequent, *once)
    sizes = settle(own.withColumn("n_frequent", F.size("frequent")).join(steps, "ref"), "sizes")

    def other(rows: DataFrame, *same: str) -> DataFrame:
        return rows.select(*(F.col(c) if c in same else F.col(c).alias(f"{c}_b") for c in rows.columns))

    def able(rare: str) -> Column:
        """By the numbers of the frequent differences first, then by what they have in common."""
        uneven = F.abs(F.col("n_frequent") - F.col("n_frequent_b"))
        apart = F.col("n_frequent") + F.col("n_frequent_b") - 2 * F.size(F.array_intersect("frequent", "frequent_b"))
        return _able(similar, F.expr(rare) + uneven) & _able(similar, F.expr(rare) + apart)

    found = [F.col("node").alias("a"), F.col("node_b").alias("b"), F.col("label").alias("x"), F.col("label_b").alias("y")]

    # Pairs with rare differences in common: no shingle makes more than FEW * FEW / 2.
    some = rows.filter("NOT one_class").select("ref", "shingle", "node", "label")
    met = some.join(other(some, "ref", "shingle"), ["ref", "shingle"]).filter(F.col("label") > F.col("label_b"))
    met = settle(met.groupBy("ref", "node", "node_b").agg(F.count("*").alias("common")), "met")
    partners = sizes.drop("ref_label", "most_top", "most_weight")
    met = met.join(sizes, ["ref", "node"]).join(other(partners.drop("step"), "ref"), ["ref", "node_b"])
    met = met.filter(able("rare + rare_b - 2 * common"))

    # Pairs without: one of them is not in the reference's class.
    outside = sizes.filter("label <> ref_label")
    room = (1 - similar) / (1 + similar / F.col("most_top")) * (F.col("weight") + F.col("most_weight")) - F.col("rare") + 1e-6
    outside = outside.filter(room >= 0).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(room / F.col("step")))))
    partners = other(partners.withColumn("part", F.floor(F.col("rare") / F.col("step"))).drop("step"), "ref", "part")
    near_by = outside.join(partners, ["ref", "part"]).filter((F.col("label") != F.col("label_b")) & able("rare + rare_b"))
    return met.select(*found).unionByName(near_by.select(*found)).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"), F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")
    ).distinct()


def _roots(edges: DataFrame) -> DataFrame | None:
    """``label`` and ``root`` of every class that merges into another along ``edges`` (``x`` > ``y``, labels), none without
    edges. In each turn a class joins its smallest neighbour, chains are shortened until each member knows the root, and the
    edges between what are then different classes go on."""
    moves = None
    while not edges.isEmpty():
        parents = settle(edges.groupBy("x").agg(F.min("y").alias("y")), "parents")
        while True:
            up = parents.select(F.col("x").alias("y"), F.col("y").alias("root"))
            jumped = settle(
                parents.join(up, "y", "left").select("x", F.coalesce("root", "y").alias("y"), F.col("root").isNotNull().alias("moved")),
                "jumped",
            )
            parents = jumped.drop("moved")
            if jumped.filter("moved").isEmpty():
                break
        root = parents.select(F.col("x").alias("label"), F.col("y").alias("root"))
        if moves is None:
            moves = root
        else:
            # What merges now is a root or was not moved before, so no label comes twice.
            on = root.select(F.col("label").alias("root"), F.col("root").alias("next"))
            moved = moves.join(on, "root", "left").select("label", F.coalesce("next", "root").alias("root"))
            moves = settle(moved.unionByName(root), "moves")
        for end in ("x", "y"):
            of = root.select(F.col("label").alias(end), F.col("root").alias("root"))
            edges = edges.join(of, end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
        edges = settle(edges.filter("x != y").select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")), "edges")
    return moves


def classes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    similar: float = SIMILAR,
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
    star_rounds: int = STAR_ROUNDS,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``row`` (position in the scan), ``class_id`` (smallest key of its class),
    ``class_size`` and ``first`` (is it the row that stands for its class: smallest key, null last, then position).

    Texts are in one class if a chain of links joins them: a link is a probability Jaccard similarity of shingles,
    weighted by 1 + log2 of their counts, of ``similar`` or more. Texts of equal words are in one class, and so are all texts without
    words (null and empty ones among them). Rows that repeat with their key are members as any others. An empty
    table gives no rows. ``docs`` must be a table or another frame whose rows come in the same order each time.
    Intermediate tables are written while the frame is built.
    """
    signed = settle(signature_table(docs, key, text, words, bands, band_rows), "signatures")
    low = F.min(F.struct(F.col("key").isNull().alias("unknown"), "key", "row")).alias("low")
    nodes = signed.groupBy("node").agg(low, F.count("*").alias("n"), F.first("bands").alias("bands"))
    nodes = settle(nodes, "nodes")
    spread = nodes.select("node", F.col("low.row").alias("row"), F.explode(F.array_distinct("bands")).alias("band"))
    sizes = settle(spread.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1"), "sizes")
    # Nodes with company in a bucket: their buckets, the sum of these buckets' sizes, the class, and whether they have led.
    near = spread.join(sizes, "band").groupBy("node")
    near = near.agg(F.min("row").alias("row"), F.sum("n").alias("degree"), F.collect_list("band").alias("bands"))
    near = settle(near.withColumns({"label": F.col("node"), "led": F.lit(False)}), "near")
    table = settle(_shingle_table(docs, near.select("node", "row"), text, words), "shingles")
    near = near.drop("row")

    compared = None
    for turn in range(star_rounds + 1):
        placed = near.select("node", "label", "degree", "led", F.explode("bands").alias("band"))
        # Of the nodes that have not led yet, the best connected one of each bucket leads.
        rank = F.struct("degree", "node", "label")
        lead = F.max(rank if turn == star_rounds else F.when(~F.col("led"), rank)).alias("lead")
        mixed = placed.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"), lead)
        mixed = settle(mixed.filter("low < high").select("band", "lead"), "mixed")
        if mixed.isEmpty():
            break
        if turn == star_rounds:
            pairs = _apart(placed, mixed, table, similar)
        else:
            # One comparison for each class: with the best leader of all its buckets. The best connected member there
            # stands for it.
            met = placed.join(mixed, "band").filter(F.col("label") != F.col("lead.label"))
            chosen = met.groupBy("label").agg(F.max(F.struct("lead", F.struct("degree", "node").alias("best"))).alias("m"))
            pairs = chosen.select(
                F.col("m.best.node").alias("a"),
                F.col("m.lead.node").alias("b"),
                F.greatest("label", "m.lead.label").alias("x"),
                F.least("label", "m.lead.label").alias("y"),
            )
        if compared is not None:
            same = (F.greatest("a", "b") == F.col("high")) & (F.least("a", "b") == F.col("low"))
            pairs = pairs.join(compared, same, "left_anti")
        pairs = settle(pairs, "pairs")
        moves = _roots(settle(_verified(pairs, table, similar), "linked").select("x", "y"))
        if moves is not None:
            near = near.join(moves, "label", "left").withColumn("label", F.coalesce("root", "label")).drop("root")
        if turn == star_rounds:
            break
        if turn + 1 < star_rounds:
            used = pairs.select(F.col("b").alias("node")).distinct().withColumn("now", F.lit(True))
            near = near.join(used, "node", "left").withColumn("led", F.coalesce("now", "led")).drop("now")
        near = settle(near, "near")
        seen = pairs.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
        compared = seen if compared is None else compared.unionByName(seen)
    return _with_classes(signed, nodes.select("node", "low", "n"), near.select("node", "label"))


def _with_classes(signed: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Class sizes and members from counts per node; only nodes with company are joined back to the rows."""
    nodes = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    nodes = settle(nodes, "classed")
    groups = nodes.groupBy("label").agg(F.min("low").alias("low"), F.sum("n").alias("n")).filter("n > 1")
    company = settle(
        nodes.select("node", "label").join(settle(groups, "groups"), "label").select("node", F.col("low.key").alias("class_id"), F.col("low.row").alias("lead"), "n"),
        "company",
    )
    found = signed.select("key", "row", "node").join(company, "node", "left")
    return found.select(
        "key",
        "row",
        F.when(F.col("n").isNull(), F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("class_size"),
        (F.col("n").isNull() | (F.col("row") == F.col("lead"))).alias("first"),
    )


def without_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stand for their class, with all their columns."""
    (row,) = fresh(docs, "row")
    lost = classes(docs, key, text, **options).filter(~F.col("first")).select(F.col("row").alias(row))
    return docs.withColumn(row, F.monotonically_increasing_id()).join(lost.hint("merge"), row, "left_anti").drop(row)
