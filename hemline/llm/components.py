"""Connected components by alternating large and small stars, each round a staged table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hemline.llm.common import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round: neighbours move to the smallest node of their star.

    Minima are combined before the shuffle, and the joined minima are unique by node, so
    a node with very many neighbours can be split over tasks.
    """
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = both.join(least, "u")
    if large:
        moved = moved.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return moved.filter("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): the smallest node it reaches."""
    edges = stage(links.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u != v").distinct(), "links")
    mark = None
    while True:
        edges = stage(_star(_star(edges, True), False), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    # every edge now leads from a node to the smallest of its component
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
