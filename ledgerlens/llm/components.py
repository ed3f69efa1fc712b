"""Connected components by alternating large-star and small-star steps.

Each step is one sum by node and one join, whatever the shape of the graph, and
turns the links into stars around the smallest node; edges of a hub are spread
by Spark's skew handling. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hooked = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hooked.unionByName(least.withColumnRenamed("m", "v")).distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node is either a centre or has one link, to a centre; then more steps change nothing."""
    leaf, centre = (F.struct(F.col(c).alias("node"), F.lit(n).alias("leaf")) for c, n in (("u", 1), ("v", 0)))
    ends = edges.select(F.explode(F.array(leaf, centre)).alias("end"))
    uses = ends.select("end.*").groupBy("node").agg(F.sum("leaf").alias("as_leaf"), F.min("leaf").alias("least"))
    return uses.filter("as_leaf > 1 OR (as_leaf = 1 AND least = 0)").limit(1).count() == 0


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the smallest node of its component."""
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "components")
    while not _all_stars(edges):
        edges = stored(_small_star(_large_star(edges)), "components")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
