"""Connected components of very large graphs by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatloom.runtime import discard, materialise


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """Directed edges (u, v) -> u, least of u and its v. Written out, so a join on it can split hot nodes."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("m"))
    return materialise(least, "least")


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """Undirected edges -> node, component (the least node of its component), for all nodes of some edge.

    Each round connects nodes to the least node seen near them, which halves depths; rounds stop when
    the edges no longer change. Loops and repeated edges are allowed, rows with a null end are left out.
    Hubs are safe: minima come from partial aggregation and the joins have written tables on both sides.
    """
    a, b = F.col(left), F.col(right)
    current = materialise(
        edges.filter(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    state = None
    while True:
        # large star: larger neighbours of a node move to its least neighbour
        both = materialise(current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
        near = _least_neighbour(both)
        larger = both.join(near, F.col("u") == F.col("node")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        larger = materialise(larger.filter("u != v").distinct(), "large-star")
        discard(current, both, near)
        # small star: a node and its smaller neighbours move to the least of them
        near = _least_neighbour(larger)
        starred = larger.join(near, F.col("u") == F.col("node"))
        smaller = starred.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        current = materialise(smaller, "small-star")
        discard(larger, near)
        new = current.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if new == state:
            break
        state = new
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return roots.unionByName(current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
