"""Connected components of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridelake.llm import tables


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Each node's neighbours (larger ones, or smaller ones) are linked to its least neighbour."""
    if small:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = tables.cut(near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    met = tables.skewed_join(near, least, ["u"])
    if not small:
        met = met.where("v > u")  # smaller neighbours keep their own stars
    out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Has every larger end one edge only, to a node that is no larger end itself?"""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    open_ = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up > 0 AND down > 0")
    return open_.agg(F.count(F.lit(1))).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (least node reachable) of all nodes of ``links`` (``a``, ``b``).

    The rounds end when the edges are stars: every centre is smaller than its leaves, so it is
    the least node of its component.  Nothing but a count reaches the driver.
    """
    edges = tables.cut(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _are_stars(edges):
        edges = tables.cut(_star(_star(edges, small=False), small=True))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
