"""Connected components of an edge table, by joins and minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``edges``
    (columns ``u`` and ``v``, any order, loops and repeats allowed).

    Alternates large-star and small-star steps: every node hands the smallest
    of its neighbours to the others until each component is a star around its
    smallest node. A step is a minimum per node (combined before the shuffle)
    joined back to the edges, so a node of very many edges is split like any
    skewed join. Each round is written to the shared checkpoint folder.
    """
    norm = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    e = checkpointed(norm)
    known = _sign(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: neighbours above u go to the smallest of u's neighbourhood.
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct())
        # Small star: neighbours below u, and u itself, go to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = checkpointed(small.select("u", F.col("m").alias("v"))
                         .unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v"))
                         .distinct())
        now = _sign(e)
        if now == known:
            break
        known = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _sign(e: DataFrame) -> tuple:
    """Row count and an order-free digest of the edges: equal when a round changed nothing."""
    r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]
