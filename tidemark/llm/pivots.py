"""Embedding near-duplicates with a pivot-permutation index.

Reference points (pivots) are a sample of the vectors. A vector is described by
its nearest pivots in order, and stands in the inverted list of each of them.
Two vectors are a candidate pair if their descriptions share enough pivots;
candidates are verified by their cosine in double precision. A pair is counted
in the list of the lowest pivot it shares, so once.

A list that is long, as that of a crowded neighbourhood, is dealt into blocks,
and pairs of blocks are compared in separate tasks. A task reports how many
links each vector has and a forest of them, never the pairs. Exact copies are
one vector with a weight.

Null and zero vectors, and such with null or non-finite components, link with
nothing. Vectors of different lengths never link. Vectors that
share a vec_id are one node. A null vec_id is below all others. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import land, table
from tidemark.llm.graph import Forest, components

NO_ID = np.iinfo(np.int64).min
LISTS = "pivot int, item bigint, weight bigint, vector binary, near binary"
FOUND = "item bigint, links bigint, root bigint"


def usable(vector: str) -> Column:
    """Not null, not zero, and of finite components only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one. Scaling by the largest component first keeps squares in range."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def spread(points: np.ndarray, most_alike: float) -> np.ndarray:
    """The points, without those closer to an earlier one that stays.

    In a crowd of near copies many pivots would all be equally near, and the
    order in which a member sees them would be chance.
    """
    stay: list[int] = []
    for i in range(len(points)):
        if not stay or (points[stay] @ points[i]).max() <= most_alike:
            stay.append(i)
    return points[stay]


def choose_pivots(vectors: DataFrame, per_root: float, least: int, most: int, alike: float) -> dict[int, np.ndarray]:
    """About ``per_root * sqrt(n)`` distinct vectors, by dimension: a bounded sample.

    Pivots lie at least twice the angle of a link apart.
    """
    n = max(least, min(most, math.ceil(per_root * math.sqrt(vectors.count()))))
    rows = vectors.orderBy(F.xxhash64("item", F.lit(1)), "item").limit(n).select("vector").collect()
    by_length: dict[int, list] = {}
    for row in rows:
        by_length.setdefault(len(row.vector), []).append(row.vector)
    return {d: spread(unit(np.array(v)), 2 * alike * alike - 1) for d, v in by_length.items()}


def nearest(rows: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """Numbers of the ``length`` nearest pivots of unit rows, the nearest first."""
    length = min(length, len(pivots))
    close = rows @ pivots.T
    if length < len(pivots):
        best = np.argpartition(-close, length - 1, axis=1)[:, :length]
    else:
        best = np.tile(np.arange(length), (len(rows), 1))
    order = np.argsort(-np.take_along_axis(close, best, axis=1), axis=1, kind="stable")
    return np.take_along_axis(best, order, axis=1).astype(np.int32)


def lister(pivots: dict[int, np.ndarray], length: int, rows_at_once: int = 512):
    """Tasks: vectors to their entries in the inverted lists."""
    first, at = {}, 0
    for dimension, points in sorted(pivots.items()):
        first[dimension], at = at, at + len(points)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, rows_at_once):
                part = batch.slice(begin, rows_at_once)
                items, weights, vectors = (part.column(c).to_pylist() for c in ("item", "weight", "vector"))
                out: list[list] = [[], [], [], [], []]
                lengths = np.array([len(v) for v in vectors])
                for dimension in np.unique(lengths).tolist():
                    own = np.flatnonzero(lengths == dimension)
                    rows = np.array([vectors[i] for i in own], np.float64)
                    if dimension in pivots:
                        near = nearest(unit(rows), pivots[dimension], length) + first[dimension]
                    else:  # a length that the sample missed: one list of its own
                        near = np.full((len(own), 1), -dimension, np.int32)
                    for i, row, places in zip(own.tolist(), rows, near):
                        n = len(places)
                        for k, v in enumerate((items[i], weights[i], row.tobytes(), places.tobytes()), 1):
                            out[k] += [v] * n
                        out[0] += places.tolist()
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                names = [c.split()[0] for c in LISTS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    return entries


def owned(near1: np.ndarray, near2: np.ndarray, pivot: int, shared: int) -> np.ndarray:
    """Pairs of descriptions that share enough pivots, ``pivot`` being the lowest of them."""
    same = near1[:, :, None] == near2[:, None, :]
    count = same.any(axis=2).sum(axis=1)
    lowest = np.where(same.any(axis=2), near1, np.iinfo(np.int32).max).min(axis=1)
    return (count >= np.minimum(shared, near1.shape[1])) & (lowest == pivot)


def verifier(least: float, shared: int, rows_at_once: int = 128, pairs_at_once: int = 65_536):
    def verify(group: pa.Table) -> pa.Table:
        """Links of one block, or between two blocks, of one pivot's list."""
        group = group.sort_by("item")
        pivot, one, other = (group.column(c)[0].as_py() for c in ("pivot", "one", "other"))
        items = group.column("item").to_numpy()
        weights = group.column("weight").to_numpy()
        block = group.column("block").to_numpy()
        rows = unit(np.array([np.frombuffer(v, np.float64) for v in group.column("vector").to_pylist()]))
        near = np.array([np.frombuffer(v, np.int32) for v in group.column("near").to_pylist()])
        left = np.flatnonzero(block == one)
        right = np.flatnonzero(block == other)
        links, forest = np.zeros(len(items), np.int64), Forest(len(items))
        for begin in range(0, len(left), rows_at_once):
            part = left[begin : begin + rows_at_once]
            hits = rows[part] @ rows[right].T >= least
            if one == other:
                hits &= right[None, :] > part[:, None]
            i, j = np.nonzero(hits)
            for a in range(0, len(i), pairs_at_once):
                x, y = part[i[a : a + pairs_at_once]], right[j[a : a + pairs_at_once]]
                hits[i[a : a + pairs_at_once], j[a : a + pairs_at_once]] = owned(near[x], near[y], pivot, shared)
            links[part] += hits @ weights[right]
            links[right] += weights[part] @ hits
            for k in np.flatnonzero(hits.any(axis=1)).tolist():
                forest.join(int(part[k]), right[hits[k]].tolist())
        with_links = np.flatnonzero(links)
        roots = np.array([forest.find(int(k)) for k in with_links], np.int64)
        columns = [pa.array(items[with_links]), pa.array(links[with_links]), pa.array(items[roots])]
        return pa.Table.from_arrays(columns, ["item", "links", "root"])

    return verify


def near_vectors(
    vectors: DataFrame, least: float, length: int, shared: int, per_root: float, pivots: tuple[int, int], block: int
) -> tuple[DataFrame, DataFrame]:
    """Links per item, and components, of ``item, weight, vector`` rows."""
    points = choose_pivots(vectors, per_root, *pivots, least)
    lists = land(vectors.mapInArrow(lister(points, length), LISTS), "pivot-lists")
    sizes = lists.groupBy("pivot").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = lists.join(land(sizes, "pivot-sizes"), "pivot").withColumn(
        "block", F.pmod(F.xxhash64("item"), "blocks").cast("int")
    )
    met = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "pivot",
        F.least("block", "with").alias("one"),
        F.greatest("block", "with").alias("other"),
        "block",
        "item",
        "weight",
        "vector",
        "near",
    )
    found = land(met.groupBy("pivot", "one", "other").applyInArrow(verifier(least, shared), FOUND), "pivot-links")
    counts = found.groupBy("item").agg(F.sum("links").alias("links"))
    edges = found.filter("item <> root").select(F.col("item").alias("a"), F.col("root").alias("b"))
    return counts, components(edges)


def near_duplicates(
    embeddings: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    least: float = 0.9,
    length: int = 10,
    shared: int = 2,
    per_root: float = 4.0,
    pivots: tuple[int, int] = (64, 16_384),
    block: int = 2048,
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Descriptions are ``length`` pivots long; candidates share ``shared`` of
    them. The sample of pivots grows with the root of the number of vectors
    between the bounds ``pivots``. Recall against brute force is in the tests.
    """
    vector = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = embeddings.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("vec"), vector.alias("vector"))
    good = rows.filter(usable("vector"))
    distinct = land(good.groupBy("vector").agg(F.min("vec").alias("item"), F.count("*").alias("weight")), "vectors")
    counts, groups = near_vectors(distinct.select("item", "weight", "vector"), least, length, shared, per_root, pivots, block)
    told = distinct.select("vector", "item", "weight").join(counts, "item", "left")
    told = told.join(groups, told["item"] == groups["node"], "left").select(
        F.col("vector").alias("same"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "item").alias("component"),
    )
    told = land(told, "vector-groups")
    key = F.when(usable("vector"), F.col("vector"))
    joined = rows.withColumn("key", key).join(told, F.col("key") == F.col("same"), "left")
    component = F.coalesce("component", "vec")

    def named(column: Column) -> Column:
        return F.when(column != F.lit(NO_ID), column)

    return joined.select(
        named(F.col("vec")).alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        named(component).alias("component_id"),
        (F.col("vec") == component).alias("kept"),
    )


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
