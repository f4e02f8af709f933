"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of about equal size. While the same sources have blocks left, time is dealt out in
periods: in one of ``n`` slots, a source with weight ``c`` places ``c`` blocks, its ``i``-th (from 0) released
in slot ``floor(i n / c)`` and due by slot ``ceil((i + 1) n / c)``. Each slot goes to the released block that is due first,
which meets every deadline, so a source is less than one block from its share after every slot. When
a source runs out, the others go on in their proportions. Periods of a kind are all alike: only one of
each kind is scheduled, and a block finds its slot by its number.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from shelfspark.llm.frames import named

#: Characters in a block.
BLOCK = 16_384
#: Sources are numbered off in so many parts.
PARTS = 1024


def _group(source: Column, targets: Mapping[str, int]) -> Column:
    """Number of the source's target, in their order; all sources without a target share the last one."""
    out = F.lit(len(targets))
    for i, name in enumerate(targets):
        out = F.when(source.eqNullSafe(F.lit(name)), F.lit(i)).otherwise(out)
    return out


def _schedule(totals: DataFrame, units: list[int]) -> DataFrame:
    """For each group and block of a period: the periods it holds for (``since``, ``until``), their ``length``, the first
    slot and the slot within. As many rows as there are slots in all kinds of periods, which the targets bound."""
    weights = F.array(*(F.lit(u) for u in units))
    sources = totals.agg(F.sort_array(F.collect_list(F.struct("grp", "blocks"))).alias("own")).select(
        F.transform(
            "own",
            lambda s: F.struct(
                s["grp"].alias("grp"),
                F.get(weights, s["grp"]).alias("unit"),
                F.floor(s["blocks"] / F.get(weights, s["grp"])).cast("bigint").alias("full"),
                (s["blocks"] % F.get(weights, s["grp"])).cast("int").alias("rest"),
            ),
        ).alias("own")
    )
    edges = F.array_sort(
        F.array_distinct(
            F.concat(
                F.array(F.lit(0).cast("bigint")),
                F.transform("own", lambda s: s["full"]),
                F.transform("own", lambda s: s["full"] + (s["rest"] > 0).cast("bigint")),
            )
        )
    )
    kinds = sources.withColumn("edges", edges).select("own", "edges", F.posexplode(F.slice("edges", 1, F.size("edges") - 1)).alias("kind", "since"))
    kinds = kinds.withColumn("until", F.get("edges", F.col("kind") + 1))
    kinds = kinds.withColumn(
        "part",
        F.filter(
            F.transform(
                "own",
                lambda s: F.struct(
                    s["grp"].alias("grp"),
                    F.when(F.col("since") < s["full"], s["unit"])
                    .when(F.col("since") == s["full"], s["rest"])
                    .otherwise(F.lit(0))
                    .alias("c"),
                ),
            ),
            lambda s: s["c"] > 0,
        ),
    ).withColumn("length", F.aggregate("part", F.lit(0), lambda a, s: a + s["c"]))
    # The fold keeps how many blocks each group has placed and which group got each slot.
    kinds = kinds.withColumn(
        "order",
        F.expr(
            """
            aggregate(
              sequence(0, length - 1),
              struct(transform(part, s -> 0) AS done, cast(array() AS array<int>) AS picked),
              (state, t) -> transform(
                array(array_min(filter(
                  transform(part, (s, i) -> struct(
                    cast(ceil((state.done[i] + 1) * length / s.c) AS int) AS due,
                    i AS at,
                    state.done[i] < s.c AND floor(state.done[i] * length / s.c) <= t AS ready)),
                  x -> x.ready))),
                x -> struct(
                  transform(state.done, (d, i) -> IF(i = x.at, d + 1, d)) AS done,
                  concat(state.picked, array(x.at)) AS picked))[0],
              state -> state.picked)
            """
        ),
    )
    base = F.coalesce(
        F.sum(F.col("length") * (F.col("until") - F.col("since"))).over(W.orderBy("since").rowsBetween(W.unboundedPreceding, -1)),
        F.lit(0),
    )
    slots = kinds.withColumn("base", base).select(
        "since", "until", "length", "base", "part", F.posexplode("order").alias("within", "picked")
    )
    slots = slots.withColumn("grp", F.get("part", F.col("picked"))["grp"])
    nth = F.row_number().over(W.partitionBy("since", "grp").orderBy("within")) - 1
    return slots.select("grp", nth.alias("nth"), "since", "until", "length", "base", "within")


def positions(
    docs: DataFrame,
    targets: Mapping[str, int],
    rest: int = 1,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block: int = BLOCK,
    parts: int = PARTS,
    carry: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``source``, ``block`` (number within its group, from 0), ``slot`` of
    that block in the mixture (from 0), ``start`` (characters of the group before the row) and, with ``carry``, the whole
    row as the struct ``row``.

    ``targets`` gives whole-number weights by source; all other sources, null among them, form one group of weight
    ``rest``. Rows of a group are in the order of an MD5 digest of the key, which shuffles them; a row belongs to
    the block in which it starts. A row of no characters (null or empty text) is at its place in the order. Rows that
    repeat with their key are adjacent. Nothing is dropped or repeated; an empty table gives no rows.
    """
    units = [*targets.values(), rest]
    if not all(isinstance(u, int) and u > 0 for u in units):
        raise ValueError("weights must be positive whole numbers")
    digest = F.md5(F.coalesce(named(key).cast("string"), F.lit("")))
    rows = docs.select(
        named(key).alias("key"),
        named(source).alias("source"),
        _group(named(source), targets).alias("grp"),
        F.length(F.coalesce(named(text), F.lit(""))).cast("bigint").alias("chars"),
        digest.alias("digest"),
        *([F.struct(*map(named, docs.columns)).alias("row")] if carry else []),
    ).withColumn("part", F.conv(F.substring("digest", 1, 4), 16, 10).cast("int") % parts)

    sums = rows.groupBy("grp", "part").agg(F.sum("chars").alias("chars"))
    before = F.sum("chars").over(W.partitionBy("grp").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    offsets = sums.select("grp", "part", F.coalesce(before, F.lit(0)).alias("offset"))
    totals = sums.groupBy("grp").agg(F.greatest(F.lit(1), F.ceil(F.sum("chars") / block)).cast("bigint").alias("blocks"))

    # Groups and parts number (targets + 1) * parts at most, and the slots do not grow with the data either.
    order = W.partitionBy("grp", "part").orderBy("digest", "key", "chars").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum("chars").over(order), F.lit(0)))
    rows = rows.join(F.broadcast(offsets), ["grp", "part"]).withColumn("start", F.col("start") + F.col("offset"))
    unit = F.get(F.array(*(F.lit(u) for u in units)), F.col("grp"))
    rows = (
        rows.join(F.broadcast(totals), "grp")
        .withColumn("block", F.least(F.floor(F.col("start") / block), F.col("blocks") - 1).cast("bigint"))
        .withColumn("period", F.floor(F.col("block") / unit).cast("bigint"))
        .withColumn("nth", (F.col("block") % unit).cast("int"))
    )
    at = _schedule(totals, units)
    mixed = rows.join(F.broadcast(at), ["grp", "nth"]).filter("period >= since AND period < until")
    slot = F.col("base") + (F.col("period") - F.col("since")) * F.col("length") + F.col("within")
    return mixed.select(
        F.col("key").alias(key), F.col("source").alias(source), "block", slot.cast("bigint").alias("slot"), "start", *(["row"] if carry else [])
    )


def mixture(docs: DataFrame, targets: Mapping[str, int], rest: int = 1, **options) -> DataFrame:
    """All rows and columns of ``docs`` in the order of the mixture, so that its files, one after another, hold it."""
    at = positions(docs, targets, rest, carry=True, **options)
    return at.orderBy("slot", "start").select("row.*")
