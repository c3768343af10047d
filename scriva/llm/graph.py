"""Connected components of an edge table, by repeated neighbour minima with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriva.llm.common import Scratch


def connected(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """edges (a, b) -> (node, component): every node of an edge and the smallest node it reaches.

    Each round links every node's larger neighbours to its smallest one, then its smaller neighbours likewise (large and small
    stars); the number of rounds grows with the logarithm of the longest chain. The table never has more rows than edges, and
    each round is written to the shared folder, where it replaces the one before; the last one goes with scratch. Rounds go on
    until every edge leads from a node to the least of its component.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    before = Scratch(spark)
    pairs = before.stored(pairs, "graph-pairs")
    while True:
        both = pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: neighbours above a node go to the least of its neighbourhood.
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: a node and its smaller neighbours go to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u")
        after = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(tied.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now = Scratch(spark)
        pairs = now.stored(after, "graph-round")
        before.drop()
        before = now
        # Finished when every edge leads to a node that is nobody's child.
        if pairs.join(pairs.select(F.col("u").alias("v")).distinct(), "v", "left_semi").isEmpty() and pairs.groupBy("u").count().where("count > 1").isEmpty():
            break
    if scratch:
        scratch.paths += before.paths
    roots = pairs.select(F.col("v").alias("node")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))

