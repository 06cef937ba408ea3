"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.scratch import written


def contracted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of one task as stars: (smallest node of a component, each other node of it)."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for x, y in zip(place[:len(a)].tolist(), place[len(a):].tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    least = np.array([root(i) for i in range(len(nodes))], dtype=np.int64)
    other = np.flatnonzero(least != np.arange(len(nodes)))
    return nodes[least[other]], nodes[other]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest."""
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = written(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("u", "m")).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node), for every node of ``edges`` (a, b: long).

    Alternates large- and small-star (Kiveris et al., 2014) until every node
    hangs on its smallest; each round is written to the shared folder.  A round
    moves edges, it never adds any.  A node's smallest neighbour is written first,
    so both sides of its join are plain exchanges and a node with very many
    neighbours is split as a skewed join.  Nulls are left out; a self-link keeps its node alone.
    """
    edges = edges.toDF("a", "b").filter("a is not null and b is not null")
    alone = edges.filter("a = b").select(F.col("a").alias("node"))
    state = written(edges.filter("a <> b").distinct(), "links")
    before = None
    while True:
        state = written(_small_star(_large_star(state)), "stars")
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    hung = state.select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = hung.union(state.select("b").distinct().select("b", "b"))  # what hangs on a root is no root
    alone = written(alone.distinct(), "alone")
    if not alone.isEmpty():
        found = found.union(alone.join(found, "node", "left_anti").select("node", "node"))
    return found
