"""Connected components of an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import stored


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """node and root of every node that occurs in ``edges`` (a, b longs); the root is the smallest node reachable.

    Alternates two steps until nothing changes: a node's larger neighbours are moved to its least neighbour, then its
    smaller ones are.  Each step is written to the shared folder, so the plan stays short and a lost executor costs
    one step.  The minima are aggregated before the shuffle; a node with very many neighbours is an ordinary skewed
    join key.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_least(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct(), "edges")
        own = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = _least(own)
        small = own.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        now = stored(small, "edges")
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (seen.n, seen.s) == mark:
            break
        mark = (seen.n, seen.s)
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
