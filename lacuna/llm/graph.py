"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.llm.common import settle


def _mins(arcs: DataFrame) -> DataFrame:
    return arcs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour."""
    arcs = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    return arcs.join(_mins(arcs), "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    arcs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = _mins(arcs)
    ties = arcs.join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return ties.union(low.select(F.col("m").alias("a"), F.col("u").alias("b"))).where("a <> b").distinct()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the least node reachable, for every node that has a link.

    Two rounds of group minima and joins a step, about log(n) steps; each step is
    checkpointed.  Minima are combined before the shuffle and the joins are plain
    equi-joins, so a node with very many links is split like any skewed key.
    Self links and repeated links are ignored; no links give no rows.
    """
    edges = settle(links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct())
    seen = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            break
        seen = now
        edges = settle(_small(_large(edges)))
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.union(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
