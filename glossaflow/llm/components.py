"""Connected components of a graph given as a table of links."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossaflow.scratch import scratch_folder, stage


def as_edges(links: DataFrame) -> DataFrame:
    """Links (``a, b``) between different nodes as ``(u, v)``, u above v."""
    return links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("least"))


def _star_step(edges: DataFrame) -> DataFrame:
    """A large-star and a small-star step: every node sends its larger, then its smaller neighbours to the smallest.

    Both are a minimum per node (combined before the shuffle) and an equi-join with it. What is connected stays
    connected, and there never are more edges than before.
    """
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    to = _least(both).select("u", F.least("u", "least").alias("least"))
    large = both.where("v > u").join(to, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    below = _least(large)
    moved = large.join(below, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.union(below.select("u", F.col("least").alias("v"))).where("u != v").distinct()


def _is_done(edges: DataFrame) -> bool:
    """Whether every node has one edge up, to a node that has none."""
    ends = edges.select("u", F.lit(1).alias("up"), F.lit(0).alias("top")).union(
        edges.select(F.col("v").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("top")))
    open_nodes = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("top").alias("top")).where("up + top > 1")
    return open_nodes.agg(F.count("*")).first()[0] == 0


def star_forest(edges: DataFrame) -> DataFrame:
    """``(u, v)``: every node but the smallest of its component, and that smallest node.

    Every step is written to the shared folder, so lineage stays short. The result can be joined by further edges
    and taken through this again.
    """
    folder = scratch_folder(edges.sparkSession)
    while True:
        edges = stage(_star_step(edges), uuid.uuid4().hex, folder)
        if _is_done(edges):
            return edges


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node that ``links`` (``a, b``) join to another one; the component is its
    smallest node."""
    edges = star_forest(as_edges(links))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
