"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.storage import kept

MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): component is the smallest node reachable.

    A round points all larger neighbours of a node at its smallest neighbour, then all smaller
    ones; rows stay at most as many as links, and a hub is only ever met through its minimum.
    Each half round is a table in the shared folder. Loops and null ends are left out.
    """
    edges = kept(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    before = None
    for _ in range(MOST_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = _contracted(both, "v > u", with_self=False)
        edges = _contracted(edges, None, with_self=True)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the links' components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _contracted(edges: DataFrame, chosen: str | None, with_self: bool) -> DataFrame:
    """New edges (neighbour, smallest): from each u's chosen neighbours, and u itself if asked, to the least of u and its neighbours."""
    least = kept(edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("of"), F.least("u", "m").alias("least")), "least")
    joined = edges.where(chosen) if chosen else edges
    moved = joined.join(least, F.col("u") == F.col("of")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    if with_self:
        moved = moved.unionByName(least.select(F.col("of").alias("u"), F.col("least").alias("v")))
    return kept(moved.where("u <> v").distinct(), "edges")
