"""Connected components of a distributed edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.staging import stage


def _signature(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges; read from the written table."""
    hashed = F.xxhash64("hi", "lo")
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(hashed).alias("x"),
        F.sum(hashed.cast("decimal(38,0)")).alias("s"),
    ).first()
    return row["n"], row["x"], row["s"]


def components(edges: DataFrame, name: str = "component") -> DataFrame:
    """(node, component) for every node of the undirected edges (a, b); component: its least node.

    Alternating stars: every edge is moved to the least neighbour of its lesser end, then every node
    hangs its lesser neighbours under the least of them, until nothing moves. A path of n nodes needs
    about log n rounds. Each round is written to the shared folder. Minima are combined before they
    are shuffled and the joins are plain equi-joins, so a hub with a third of all edges is
    split by the skew-join rule; no node's edges are gathered. Null ends and loops are left out.
    """
    current = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(),
        name,
    )
    seen = _signature(current)
    while seen[0]:
        near = (
            current.select(F.col("lo").alias("node"), F.col("lo").alias("other"))
            .union(current.select("hi", "lo"))
            .groupBy("node")
            .agg(F.min("other").alias("least"))
        )
        # A lesser end with no lesser neighbour keeps its edges: only the others are joined.
        large = current.join(near.withColumnRenamed("node", "lo"), "lo").select("hi", F.col("least").alias("lo"))
        least = large.groupBy("hi").agg(F.min("lo").alias("least"))
        hung = large.join(least, "hi").where("lo <> least").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
        current = stage(hung.union(least.select("hi", F.col("least").alias("lo"))).distinct(), name)
        now = _signature(current)
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)
