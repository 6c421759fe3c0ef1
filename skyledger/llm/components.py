"""Connected components: inside a task with numpy, across tasks with joins."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.inputs import stored


def roots(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node that each of ``size`` nodes reaches over the links a-b."""
    parent = np.arange(size)
    while True:
        low, high = np.minimum(parent[a], parent[b]), np.maximum(parent[a], parent[b])
        open_ = low < high
        if not open_.any():
            return parent
        np.minimum.at(parent, high[open_], low[open_])
        while True:
            upper = parent[parent]
            if (upper == parent).all():
                break
            parent = upper


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """node and root (the smallest node reachable) of every node that an edge (a, b) touches.

    Alternating large-star and small-star steps: each node's larger neighbours,
    then its smaller ones, are hung on its smallest. Only minima are combined
    per node, before the shuffle, so a node with very many neighbours is no
    burden to one task; every round is checkpointed.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = stored(pairs)
    before = None
    for _ in range(rounds):
        state = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (state.n, state.s) == before:
            break
        before = (state.n, state.s)
        both = pairs.union(pairs.select("b", "a"))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("low"))
        large = both.join(least, F.col("a") == F.col("node")).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        least = large.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
        small = large.join(least, F.col("a") == F.col("node")).select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("low").alias("b")), F.struct(F.col("a"), F.col("low").alias("b")))).alias("p")).select("p.*")
        pairs = stored(small.where("a <> b").distinct())
    else:
        raise RuntimeError("components did not settle")
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
