"""Connected components of a graph given by its edges, in rounds of stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node to the smallest of them and the node.

    Large stars move the neighbours that are larger than the node, small stars the smaller ones and the
    node itself. Minima are taken before the shuffle, and the join's two sides are plain, so that a node
    with very many neighbours can be split.
    """
    if large:
        edges = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stored(edges.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m")), "least")
    joined = edges.join(least, "a")
    if large:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return moved.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b) that is not the smallest of its component.

    The component is its smallest node. Repeated edges and loops do no harm; no edges give no rows. Rounds
    end when the edges are stars, after about the logarithm of the longest path.
    """
    now, before = stored(edges.where("a != b").select("a", "b").distinct(), "edges"), None
    total = F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))
    while True:
        mark = now.agg(F.count("*"), total).first()
        if mark[0] == 0 or mark == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = mark
        now = stored(_star(stored(_star(now, True), "large"), False), "small")
