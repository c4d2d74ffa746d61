"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import stored


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; the component is its smallest node.

    Every round is a written table; a node's neighbours are never gathered, only their minimum.
    Links to itself and repeated links do no harm; nulls are left out.
    """
    pairs = links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    edges = stored(
        pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "component-links"
    )
    nodes = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    before = None
    while True:
        # large star: every larger neighbour of a node joins the smallest node around it
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).where(F.col("a") != F.col("b")).distinct()
        # small star: a node and its smaller neighbours join the smallest of them
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small_least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(moved.union(small_least.select("a", F.col("m").alias("b"))).distinct(), "component-links")
        now = _mark(edges)
        if now == before:
            break
        before = now
    roots = edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    return nodes.join(roots, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
