"""Connected components of a graph given by links, by alternating star contractions.

Every round re-links, for each node, its neighbours to the smallest of them. Rounds are logarithmic in practice; each
is written to the shared folder, so lineage stays short, and nothing but a count comes to the driver. Hubs do not
gather in a task: minima are summed map-side, and the joins are plain ones that Spark splits at hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``a``, ``b``); the root is the smallest node reachable."""
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while not _are_stars(edges):
        edges = stage(_small_star(_large_star(edges)), "links")
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node hangs on one root and no root hangs on another; links are distinct and go to smaller nodes."""
    sides = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = sides.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not ends.where("up > 1 OR (up = 1 AND down = 1)").head(1)


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node around it, itself included."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links the smaller neighbours of a node, and the node, to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).where("u <> v").distinct()
