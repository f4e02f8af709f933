"""Merkle manifest of a dataset: a tree for each group of rows, a tree over the groups, and a proof for every row.

A node's place in its tree is its rank, and the ranks' digits to the base of the fan-out are the way to it. A block holds
the nodes that agree in all but their last digits; inside it the digits are grouped away one after the other, each time
nesting the children's structs in their parent, so that a block ends as one row of bounded size. The last transform walks
down the nested structs, explodes the children and hands each the siblings that it meets: proofs come from
the block itself, without a join. Block roots are the nodes of the next tier, with blocks of their own, until one is
left; a block gets the rest of its way from its tier above by its number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfspark.llm.frames import named
from shelfspark.session import settle

FANOUT = 3
#: Levels of a block: FANOUT ** LEVELS = 729 nodes at most, some 150 KB.
LEVELS = 6
STEP = "struct<left: string, right: string>"


def field(value: Column) -> Column:
    """How a value enters a leaf: ``-`` for null, else its bytes in UTF-8, counted."""
    value = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*(field(v) for v in values)), 256)


def ranked(nodes: DataFrame, group: str, *order: str) -> tuple[DataFrame, DataFrame]:
    """``nodes`` with ``grp`` (number of the group, in order of its name, null first) and ``rank`` (in the group, from 0, in ``order``),
    and a row for each group: ``group``, ``grp``, ``size``.

    Rows are sorted by range over all tasks and counted per task, so that a group of any size is spread. ``order`` must tell
    rows apart. The names of the groups are ranked in the same way.
    """
    by = [F.col(c).asc_nulls_first() for c in (group, *order)]
    spread = nodes.repartitionByRange(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)
    placed = spread.sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    placed = settle(placed.withColumn("part", F.spark_partition_id()), "placed")
    counts = settle(placed.groupBy(group, "part").agg(F.count("*").alias("n"), F.min("at").alias("first")), "counts")
    sizes = counts.groupBy(group).agg(F.sum("n").alias("size"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first"))
    groups = settle(_numbered(sizes, group), "groups")
    starts = starts.alias("s").join(groups.alias("g"), F.expr(f"s.`{group}` <=> g.`{group}`")).select(f"s.{group}", "part", "base", "grp")
    starts = settle(starts, "starts").withColumnsRenamed({group: "its_group", "part": "its_part"})
    found = placed.join(starts, (F.col("part") == F.col("its_part")) & F.col(group).eqNullSafe(F.col("its_group")))
    return found.withColumn("rank", F.col("at") + F.col("base")).drop("its_group", "its_part", "at", "part", "base"), groups


def _numbered(groups: DataFrame, group: str) -> DataFrame:
    """``grp``: the number of each group in order of its name, null first."""
    by = F.col(group).asc_nulls_first()
    spread = groups.repartitionByRange(int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions")), by)
    placed = spread.sortWithinPartitions(by).withColumns({"at": F.monotonically_increasing_id(), "part": F.spark_partition_id()})
    placed = settle(placed, "numbered")
    counts = placed.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    # One row for each task of the sort, whatever the number of groups.
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("base"))
    return placed.join(settle(bases, "bases"), "part").withColumn("grp", F.col("at") + F.col("base")).drop("at", "part", "base")


def _rolled(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """A row for each block of ``nodes`` (``grp``, ``size``, ``rank``, ``digest`` and others): ``grp``, ``size``, ``block``, its root's ``digest`` and
    the nested ``children``."""
    own = [c for c in nodes.columns if c not in ("grp", "size", "rank")]
    digits = [F.pmod(F.expr(f"rank div {fanout**k}"), F.lit(fanout)).cast("int").alias(f"d{k}") for k in range(levels)]
    rows = nodes.select("grp", "size", F.expr(f"rank div {fanout**levels}").alias("block"), *digits, F.struct(*own).alias("node"))
    rows = rows.repartition("grp", "block")
    for k in range(levels):
        kept = ["grp", "size", "block", *(f"d{j}" for j in range(k + 1, levels))]
        children = F.array_sort(F.collect_list(F.struct(F.col(f"d{k}").alias("digit"), "node"))).alias("children")
        rows = rows.groupBy(*kept).agg(children)
        below = F.transform("children", lambda c: c["node"]["digest"])
        # A tree ends at the level where one node is left.
        digest = F.when(F.col("size") > fanout**k, F.sha2(F.array_join(below, ""), 256)).otherwise(below[0])
        rows = rows.select(*kept, F.struct(digest.alias("digest"), "children").alias("node"))
    return rows.select("grp", "size", "block", "node.digest", "node.children")


def _ways(fanout: int, least: int) -> Column:
    """The children with their own paths; a tree of no more than ``least`` leaves does not have this level."""
    siblings = F.transform("children", lambda c: c["node"]["digest"])

    def way(child: Column, i: Column) -> Column:
        left = F.array_join(F.slice(siblings, F.lit(1), i), "")
        right = F.array_join(F.slice(siblings, i + 2, F.lit(fanout)), "")
        step = F.array(F.struct(left.alias("left"), right.alias("right")))
        path = F.when(F.col("size") > least, F.concat(step, "path")).otherwise(F.col("path"))
        return F.struct(child["digit"].alias("digit"), child["node"].alias("node"), path.alias("path"))

    return F.transform("children", way)


def _opened(blocks: DataFrame, fanout: int, levels: int) -> DataFrame:
    """A row for each node in ``blocks`` (``grp``, ``size``, ``block``, ``children`` and ``path``, the way from the block's root): the node's
    columns and its ``path``, the siblings to the left and right at each level, from below."""
    rows = blocks.select("grp", "size", F.col("block").alias("rank"), "children", "path")
    for k in range(levels - 1, -1, -1):
        rows = rows.select("grp", "size", "rank", F.explode(_ways(fanout, fanout**k)).alias("c"))
        inner = "c.node.*" if k == 0 else "c.node.children"
        rows = rows.select("grp", "size", (F.col("rank") * fanout + F.col("c.digit")).alias("rank"), inner, "c.path")
    return rows


def tree(nodes: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> tuple[DataFrame, list[DataFrame]]:
    """Roots (``grp``, ``digest``) of the trees over ``nodes`` (``grp``, ``size`` of its group, ``rank``, ``digest``), and the tiers of
    nested blocks, from the leaves up."""
    tiers, size = [], nodes.agg(F.max("size")).first()[0] or 0
    while True:
        blocks = settle(_rolled(nodes, fanout, levels), "blocks")
        tiers.append(blocks)
        size = -(-size // fanout**levels)
        if size <= 1:
            return blocks.select("grp", "digest"), tiers
        whole = F.expr(f"(size + {fanout**levels - 1}) div {fanout**levels}")
        nodes = blocks.select("grp", whole.alias("size"), F.col("block").alias("rank"), "digest")


def paths(tiers: list[DataFrame], above: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Every leaf of ``tiers`` with its columns and ``path``, the siblings from below up to the root of its tree, followed by
    ``above`` (``grp``, ``path``), what leads on from the root."""
    ways = above.select("grp", F.lit(0).cast("bigint").alias("block"), "path")
    for i, blocks in enumerate(reversed(tiers)):
        opened = _opened(blocks.join(ways, ["grp", "block"]), fanout, levels)
        if i == len(tiers) - 1:
            return opened
        ways = settle(opened.select("grp", F.col("rank").alias("block"), "path"), "ways")
    raise ValueError("a tree has a tier at least")


def proof_digest(path: Column) -> Column:
    """Digest of the siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, leaf, lambda found, p: F.sha2(F.concat(p["left"], found, p["right"]), 256))


def manifest(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "source",
    leaf: Column | None = None,
    claimed: Column | None = None,
    fanout: int = FANOUT,
    levels: int = LEVELS,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``leaf``, ``subroot`` (of its group's tree), ``root``, ``path`` (siblings up to the root),
    ``claimed`` (the leaf as it is now) and ``folded_root``, which follows from ``claimed`` and the path.

    ``leaf`` is the digest of a row's fields (default: all five columns of documents), ``claimed`` that of the row to verify
    (default: the same). In a group leaves stand in order of ``key`` (a whole number, null first), then of their
    digests, then of their position. A null group is a group of its own and comes first, the others follow by their bytes.
    Rows that repeat are leaves as any others. A group of one leaf has it as its root, one group's root is the root of all.
    An empty table gives no rows. Only the columns that ``leaf`` and ``claimed`` read matter, whatever others are called. A text is
    hashed in the task that reads it, so it has to fit there; nothing after it holds texts. A hot group is spread over
    blocks of ``fanout`` ** ``levels`` leaves. Intermediate tables are written while the frame is built.
    """
    leaf = leaf_digest(*map(named, ("doc_id", "source", "lang", "n_chars", "text"))) if leaf is None else leaf
    rows = docs.select(
        named(key).cast("bigint").alias("key"),
        named(group).cast("string").alias("group"),
        leaf.alias("digest"),
        (leaf if claimed is None else claimed).alias("claimed"),
        F.monotonically_increasing_id().alias("row"),
    )
    leaves, groups = ranked(settle(rows, "leaves"), "group", "key", "digest", "row")
    sized = leaves.drop("group").join(groups.select("grp", "size"), "grp")
    subroots, tiers = tree(sized.select("grp", "size", "rank", "key", "digest", "claimed"), fanout, levels)
    subroots = settle(subroots, "subroots")
    n_groups = groups.count()
    tops = subroots.select(F.lit(0).alias("grp"), F.lit(n_groups).cast("bigint").alias("size"), F.col("grp").alias("rank"), "digest")
    roots, upper = tree(tops, fanout, levels)
    start = roots.select("grp", F.array().cast(f"array<{STEP}>").alias("path"))
    above = paths(upper, start, fanout, levels).select(F.col("rank").alias("grp"), F.col("digest").alias("subroot"), "path")
    above = settle(above.crossJoin(F.broadcast(roots.select(F.col("digest").alias("root")))), "above")  # one root
    found = paths(tiers, above, fanout, levels).join(above.select("grp", "subroot", "root"), "grp")
    return found.select(
        "key", F.col("digest").alias("leaf"), "subroot", "root", "path", "claimed", folded(F.col("claimed"), F.col("path")).alias("folded_root")
    )
