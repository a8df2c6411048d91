"""Connected components of an edge table, and of small edge lists inside a task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import discard, written


def local_roots(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``count`` nodes under the edges ``a``-``b``."""
    root = np.arange(count)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        for end in (a, b):
            np.minimum.at(root, root[end], low)
            np.minimum.at(root, end, low)
        while not np.array_equal(jumped := root[root], root):
            root = jumped
        if np.array_equal(before, root):
            break
        rest = root[a] != root[b]
        a, b = a[rest], b[rest]
    return root


def components(edges: DataFrame) -> DataFrame:
    """Component of every node that has an edge: (node, component), the smallest node reachable.

    ``edges`` has long columns ``a`` and ``b``; order, repeats and loops do not matter, nulls are
    left out. Large and small stars alternate until nothing changes: each round hangs every node
    on the smallest neighbour known, so the rounds grow with the logarithm of a component's size.
    Rounds are written to the shared folder; only a count and a checksum reach the driver. Nodes
    with very many neighbours are only met in joins, which Spark splits, and in minima, which are
    taken before the shuffle.
    """
    edges = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    now = written(edges.select("a", "b").distinct(), "edges")
    state = _state(now)
    while True:
        after = written(_small_star(_large_star(now)), "edges")
        reached = _state(after)
        discard(now)
        if reached == state:
            break
        now, state = after, reached
    own = after.select(F.col("b").alias("component")).distinct()
    return after.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        own.select(F.col("component").alias("node"), "component")
    )


def _state(edges: DataFrame) -> tuple:
    # a sum of 31-bit hashes cannot overflow; equal counts and sums mean that nothing moved
    row = edges.agg(
        F.count("*"), F.sum(F.hash("a", "b").cast("decimal(20,0)")), F.sum(F.hash("b", "a").cast("decimal(20,0)"))
    ).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    ).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    kept = least.select("a", F.col("m").alias("b"))
    return moved.unionByName(kept).where("a <> b").distinct()
