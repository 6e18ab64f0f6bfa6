"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is a grouped minimum (combined before the shuffle) and a join. Nodes that hold a thousandth of the edges or more,
of which there are about 2,000 at most, meet their edges by a broadcast; no neighbourhood is ever gathered. The rounds grow with the
logarithm of the longest path. Each step is written to the shared folder, so a lost executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import discard, stored


#: Least number of edges of a hub.
HUB = 256


def _meet(edges: DataFrame, least: DataFrame, hub: int) -> DataFrame:
    """``edges`` with the m of their u. ``least``: u, m, and n, the edges of u."""
    hubs = F.broadcast(least.where(F.col("n") >= hub).select("u", "m"))
    others = edges.join(hubs.select("u"), "u", "left_anti").join(least.where(F.col("n") < hub).select("u", "m"), "u")
    return edges.join(hubs, "u").unionByName(others)


def _star(edges: DataFrame, large: bool, hub: int) -> DataFrame:
    """Large: each node's greater neighbours get its least neighbour (or itself). Small: its lesser ones do."""
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        out = _meet(both.where("v > u"), least, hub).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        out = _meet(down, least, hub).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for each node with an edge; component is the least node reachable.

    ``edges`` has two long columns u and v; their order, repetition and loops do not matter; null ends don't link.
    """
    edges = edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges, last = stored(edges, "edges"), None
    most = edges.count()
    for _ in range(rounds):
        for large in (True, False):
            before, edges = edges, stored(_star(edges, large, max(HUB, most // 1000)), "edges")
            discard(before)
        now = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
