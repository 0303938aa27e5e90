"""Connected components of a distributed edge list, and of a tile in memory."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import land


class Forest:
    """Union-find over 0..n-1 whose roots are the smallest members."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def join(self, x: int, others: list[int]) -> None:
        """One set of ``x`` and all ``others``."""
        roots = {self.find(y) for y in others}
        roots.add(self.find(x))
        low = min(roots)
        for root in roots:
            self.parent[root] = low

    def edges(self) -> list[tuple[int, int]]:
        """Each member with its root, roots left out."""
        return [(x, r) for x in range(len(self.parent)) if (r := self.find(x)) != x]


def link_rows(forest: Forest, hits: np.ndarray, first: int, offset: int = 0) -> None:
    """Join row ``first + i`` with the columns ``offset + j`` of every true ``hits[i, j]``."""
    rows = np.flatnonzero(hits.any(axis=1))
    for i in rows.tolist():
        forest.join(first + i, (np.flatnonzero(hits[i]) + offset).tolist())


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``a, b`` rows; component is its smallest node.

    Alternating large-star and small-star steps (Kiveris et al., 2014): every
    round links neighbours to the smallest node seen, with sums per node only,
    until nothing changes. Each round is written to the shared folder.
    """

    def stars(rows: DataFrame) -> DataFrame:
        return rows.filter("a <> b").distinct()

    def state(rows: DataFrame) -> tuple:
        return tuple(rows.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    now = land(stars(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))), "links")
    seen = state(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = stars(both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")))
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        now = land(stars(small.unionByName(low.select("a", F.col("low").alias("b")))), "links")
        before, seen = seen, state(now)
        if seen == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
