"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tokloom.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (a, b); the component is its smallest node.

    Each round hangs every neighbour larger than a node on the least of the node's
    neighbourhood, then does the same for the smaller ones; the number of rounds grows with the logarithm
    of the longest path. Only minima per node are grouped, never neighbour lists. A round's links are
    written to the shared folder, which cuts the lineage.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    mark = (-1, None)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = stored(both.filter("b > a").join(least, "a").select(
            F.col("b").alias("a"), F.col("m").alias("b")), "links")
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        edges = stored(large.join(root, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .unionByName(root.select("a", F.col("m").alias("b")))
                       .filter("a <> b").distinct(), "links")
        before, mark = mark, _mark(edges)
        if mark == before or not mark[0]:
            break
    # now a star a component: every node but the centre has one link, to the centre
    return (edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), "b"))
            .groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node"))
