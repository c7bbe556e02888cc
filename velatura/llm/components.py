"""Connected components over an edge table, without collecting links or components.

Alternating large-star and small-star steps (Kiveris et al., 2014): each keeps the connectivity of
the edges and brings every node nearer to the smallest id of its component. Only the minimum over a
node's neighbours is needed, an aggregate with map-side combine, so a node with very many neighbours is not
gathered in one task; the join that hands the minimum back to the edges is a plain equi-join that the skew handling can split.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

FAN = 64


def tree_edges(roots: np.ndarray, fan: int = FAN) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect the indices of equal ``roots`` as trees of ``fan`` children a node."""
    order = np.argsort(roots, kind="stable")
    sorted_roots = roots[order]
    first = np.flatnonzero(np.r_[True, sorted_roots[1:] != sorted_roots[:-1]]) if len(roots) else np.empty(0, np.int64)
    start = np.repeat(first, np.diff(np.r_[first, len(roots)]))
    at = np.arange(len(roots)) - start
    child = at > 0
    return order[child], order[(start + (at - 1) // fan)[child]]


def connected_components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (src, dst): component is the smallest node reachable."""
    pairs = edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct()
    pairs = checkpointed(pairs)
    seen = None
    for _ in range(most):
        # large star: every neighbour above u goes to the smallest of u and its neighbours
        both = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: the neighbours not above u, and u itself, go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low.withColumnRenamed("u", "c"), F.col("u") == F.col("c"))
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v")))
        pairs = checkpointed(small.distinct())
        # done when edges are stars: no node is both child and centre, no child has two centres
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
