"""Connected components by alternating large stars and small stars (Kiveris et al., SoCC 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.shared import keep


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Connect each node's larger (or else smaller) neighbours with the least of the node and all its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    joined = both.join(least, "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(least.select("a", F.col("least").alias("b")))
    return moved.where("a <> b").distinct()


def labels(edges: DataFrame, folder: str) -> DataFrame:
    """node, label: the least node that edges (a, b) reach from each node that has an edge; a and b are longs.

    Each round writes its edges in the shared folder. Rounds grow with the logarithm of the longest path. A hub's edges
    are aggregated before they are shuffled; the joins are plain, so that skewed ones are split at run time.
    """
    current = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    current, before, step = keep(current, f"{folder}/0"), None, 0
    while True:  # until a round changes nothing
        signature = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if signature == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
                current.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
            )
        before, step = signature, step + 1
        current = keep(_star(_star(current, True), False), f"{folder}/{step}")
