"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hydrolake.llm.common import written


def _stars(edges: DataFrame, every: bool) -> DataFrame:
    """One step: each node's neighbours (``every``: those above it; else it and those below) are
    tied to the smallest of them. The smallest is a partial aggregation and joined back, so a
    node with very many edges is no task of its own."""
    both = edges.unionByName(edges.selectExpr("b AS a", "a AS b")) if every else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    tied = both.join(least, both.a == least.k)
    up = tied.where("b > a").selectExpr("b AS a", "m AS b") if every else (
        tied.selectExpr("b AS a", "m AS b").unionByName(least.selectExpr("k AS a", "m AS b")))
    return up.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; root is the component's smallest node.

    Large-star and small-star steps in turn until nothing changes; rounds grow with the
    logarithm of the longest path. Each round is written to the shared folder.
    """
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen, now = mark, written(_stars(_stars(now, True), False), "stars")
    return now.selectExpr("a AS node", "b AS root").unionByName(now.selectExpr("b AS node", "b AS root").distinct())
