"""Connected components of an edge table by alternating stars."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node
    reachable.  ``edges`` has columns u and v.

    Each round points a node's larger neighbours to the smallest of its
    neighbourhood (large star), then its smaller ones and itself (small star).
    Only minima are grouped, no neighbour lists; both steps are joins, so a
    node with very many edges is split like any skewed join key.  Each round
    is checkpointed; the loop ends when no edge changes.
    """
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    mark = None
    for _ in range(max_rounds):
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or now[0] == 0:
            break
        mark = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = (small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .unionByName(low.select("u", F.col("m").alias("v"))).distinct().checkpoint())
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root")))
