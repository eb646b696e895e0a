"""Connected components by alternating large-star and small-star contraction.

Every round is a pair of grouped minima and joins; rounds grow with the logarithm of the largest component, each round's
edges are written to the shared folder, and the driver only ever sees a count and a checksum. The node that a large
component is contracted to has a share of all edges: such nodes are few, and their minimum is broadcast.

Cases: edges from a node to itself and repeated edges count as none; no edges give no rows; columns besides the two are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import join_keyed, stored


def _with_least(edges: DataFrame, rows: int) -> DataFrame:
    """Edges with ``m``, the smallest neighbour of u."""
    return join_keyed(edges, edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("edges")), "u", "edges", rows)


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both, 2 * n).filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    near = _with_least(edges, n)
    pair = F.when(F.col("v") == F.col("m"), F.struct(F.col("u").alias("u"), F.col("m").alias("v"))).otherwise(F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
    return near.select(pair.alias("p")).select("p.*").distinct()


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``node, root`` for every node of an edge, its own smallest node (``root``) not listed. Root: smallest node reachable."""
    high, low = F.greatest(F.col(u), F.col(v)), F.least(F.col(u), F.col(v))
    now = stored(edges.select(high.alias("u"), low.alias("v")).filter("u <> v").distinct(), "edges")
    seen = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        now = stored(_small_star(stored(_large_star(now, state[0]), "stars"), state[0]), "edges")
