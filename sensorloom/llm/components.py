"""Connected components over an edge table, by alternating large and small stars.

Each round points the neighbours of a node to the smallest node among them. The number of rounds grows with the logarithm
of the graph. A node with very many edges is summed map-side, and the join that follows may be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sensorloom.llm.texts import checkpointed


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (u, v). Large: the larger neighbours of each node; small: the node and its smaller neighbours."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    both = both.toDF("u", "v").distinct()
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.filter("u <> m"))
    return out.distinct()


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component), the component being its smallest node. Edges (u, v) of longs; loops and repeats are allowed."""
    edges = checkpointed(edges.toDF("u", "v").filter("u <> v").distinct())
    before = _state(edges)
    while before[0]:
        edges = checkpointed(_star(_star(edges, True), False))
        now = _state(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
