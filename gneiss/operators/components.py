"""Connected components by alternating large-star and small-star rounds.

Each round is a few equi-joins and aggregates on the edges; no node's
neighbours ever meet in one task as a collection. A component is named by its
smallest node, so labels don't depend on the order of the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gneiss.operators.lineage import cut


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.expr("coalesce(bit_xor(xxhash64(hi, lo)), 0)")).head()
    return tuple(row)


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node that an edge touches; component is its smallest reachable node.

    Nulls in either column are not edges. Self loops only name their node.
    """
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    e = cut(e.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct())
    loops = e.where("hi = lo").select(F.col("hi").alias("node"))
    e = e.where("hi > lo")
    nodes = loops.unionByName(e.select(F.col("hi").alias("node"))).unionByName(e.select(F.col("lo").alias("node"))).distinct()
    mark = _mark(e)
    while mark[0]:
        both = e.select("hi", "lo").unionByName(e.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy(F.col("hi").alias("lo")).agg(F.min("lo").alias("m")).select("lo", F.least("lo", "m").alias("m"))
        large = e.join(least, "lo").select("hi", F.col("m").alias("lo")).distinct()
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        met = large.join(root, "hi")
        out = met.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).unionByName(root.select("hi", F.col("m").alias("lo")))
        out = cut(out.distinct())
        now = _mark(out)
        e, done = out, now == mark
        mark = now
        if done:
            break
    roots = e.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("component"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
