"""Connected components of a table of links, by alternating star operations.

Each round is a group-by with partial aggregation and a join, so that nothing
but a count reaches the driver and a centre with many links is spread by the
planner. The number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framequarry.llm._shared import materialize


#: Links from which a node is joined to its smallest neighbour by broadcast, and the number of such nodes at most (1 MB): all others have under 1 in ``CENTRES`` of the links.
MANY = 100_000
CENTRES = 65_536


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _to_least(near: DataFrame, least: DataFrame, count: int) -> DataFrame:
    """``near`` (u, v) joined with ``least`` (u, m, k: links of u) on u, without gathering a node of many links in one task."""
    if count <= MANY:
        return near.join(least.drop("k"), "u")
    many = materialize(least.where(F.col("k") > MANY).orderBy(F.desc("k"), "u").limit(CENTRES).select("u", F.col("m").alias("known")), "centres")
    near = near.join(F.broadcast(many), "u", "left")
    few = near.where("known is null").drop("known").join(least.drop("k"), "u")
    return few.unionByName(near.where("known is not null").withColumnRenamed("known", "m"))


def _large_star(edges: DataFrame, count: int) -> DataFrame:
    """Join every larger neighbour of a node to the smallest node around it."""
    near = _both(edges)
    least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("k"))
    return _to_least(near.where("v > u"), least, count).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame, count: int) -> DataFrame:
    """Join every smaller neighbour of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("k"))
    moved = _to_least(down, least, count).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple:
    """A fingerprint of the set of links."""
    key = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(key), F.sum(key.bitwiseAND(F.lit((1 << 31) - 1)))).first())


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component_id) of every node of ``edges`` (u, v: long), the component's id being its smallest node."""
    now = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = _mark(now)
    for _ in range(rounds):
        if not mark[0]:
            break
        # each half reads its links twice, so the first is written before the second begins
        now = materialize(_small_star(materialize(_large_star(now, mark[0]), "links"), mark[0]), "links")
        before, mark = mark, _mark(now)
        if before == mark:
            break
    else:
        raise RuntimeError("the links' components didn't settle")
    leaves = now.select(F.col("u").alias("id"), F.col("v").alias("component_id"))
    return leaves.unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct())
