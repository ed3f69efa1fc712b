"""Groups of the fraud graph: rings (connected components) and its dense core.

Both run in rounds of joins and sums over the edges. A round's edges are
written to the shared folder, which cuts the lineage. A node's smallest
neighbour and its degree are summed before the shuffle, and go back to the
edges as one row per node: the many edges of a hub may be split between tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.monitoring import count_rows
from ledgerlens.session import work_dir


def _written(df: DataFrame, label: str) -> DataFrame:
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _state(edges: DataFrame) -> tuple:
    """A digest of a set of edges."""
    mark = F.xxhash64("low", "high").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark)).head())


def _to_smallest(pairs: DataFrame, own: bool) -> DataFrame:
    """Tie each ``other`` of a node, and with ``own`` the node, to the least of the node and its others."""
    least = pairs.groupBy("node").agg(F.least("node", F.min("other")).alias("least"))
    tied = pairs.join(least, "node").select("least", F.col("other").alias("end"))
    if own:
        tied = tied.unionByName(least.select("least", F.col("node").alias("end")))
    return tied.filter("least < end").select(F.col("least").alias("low"), F.col("end").alias("high")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, ring) of every node of ``edges`` (low, high); the ring is the least node that can be reached.

    Alternates two rounds until nothing changes: every node ties its larger
    neighbours to its smallest, then its smaller ones and itself. Both keep the
    components. The edges end as stars around the least nodes, after a
    number of rounds that grows with the square of the logarithm of the nodes.
    """
    low, high = F.least("low", "high"), F.greatest("low", "high")
    present = F.col("low").isNotNull() & F.col("high").isNotNull()
    every = _written(edges.filter(present).select(low.alias("low"), high.alias("high")).distinct(), "rings")
    current, before = every.filter("low < high"), None
    while (state := _state(current)) != before:
        before = state
        down = current.select(F.col("high").alias("node"), F.col("low").alias("other"))
        both = down.unionByName(current.select(F.col("low").alias("node"), F.col("high").alias("other")))
        least = both.groupBy("node").agg(F.least("node", F.min("other")).alias("least"))
        larger = both.filter("other > node").join(least, "node").select(F.col("least").alias("low"), F.col("other").alias("high"))
        large = _written(larger.filter("low < high").distinct(), "rings")
        current = _written(_to_smallest(large.select(F.col("high").alias("node"), F.col("low").alias("other")), own=True), "rings")
    nodes = every.select(F.explode(F.array("low", "high")).alias("node")).distinct()
    return nodes.join(current.select(F.col("high").alias("node"), "low"), "node", "left").select(
        "node", F.coalesce("low", "node").alias("ring")
    )


def fraud_rings(edges: DataFrame) -> DataFrame:
    """(node, ring, ring_nodes, ring_frauds) from the weighted edges of users and merchants."""
    found = _written(components(edges.select(F.col("merchant_id").alias("low"), F.col("user_id").alias("high"))), "rings")
    sizes = found.groupBy("ring").agg(count_rows().alias("ring_nodes"))
    # An edge lies in the ring of its user.
    frauds = edges.join(found, edges["user_id"] == found["node"]).groupBy("ring").agg(F.sum("weight").alias("ring_frauds"))
    return found.join(sizes, "ring").join(frauds, "ring").select("node", "ring", "ring_nodes", "ring_frauds")


def core(edges: DataFrame, k: int) -> DataFrame:
    """(low, high): the edges left when nodes with fewer than ``k`` neighbours are taken out again and again.

    A round takes out all such nodes at once. There are as many rounds as the
    longest chain of nodes that fall one after the other.
    """
    low, high = F.least("low", "high"), F.greatest("low", "high")
    simple = edges.select(low.alias("low"), high.alias("high")).filter("low < high").distinct()
    current, count, before = _written(simple, "core"), None, -1
    while (count := current.count()) != before:
        before = count
        degree = current.select(F.explode(F.array("low", "high")).alias("node")).groupBy("node").agg(count_rows().alias("degree"))
        stay = _written(degree.filter(F.col("degree") >= k).select("node"), "core")
        kept = current.join(stay.withColumnRenamed("node", "low"), "low", "left_semi")
        current = _written(kept.join(stay.withColumnRenamed("node", "high"), "high", "left_semi").select("low", "high"), "core")
    return current


def fraud_core(edges: DataFrame, k: int = 2) -> DataFrame:
    """(node, degree) of the users and merchants in the ``k``-core of the fraud graph."""
    left = core(edges.select(F.col("merchant_id").alias("low"), F.col("user_id").alias("high")), k)
    return left.select(F.explode(F.array("low", "high")).alias("node")).groupBy("node").agg(count_rows().alias("degree"))
