from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tidemark.llm.pivots import nearest, near_duplicates, op4_embedding_dedup, spread, unit


def brute(rows, least=0.9):
    """Links and components of (id, vector) rows by all pairs."""

    def good(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    units = [unit(np.array([v], np.float64))[0] if good(v) else None for _, v in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(units):
        for j, b in enumerate(units[:i]):
            if a is not None and b is not None and len(a) == len(b) and a @ b >= least:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    low = {}
    for i, (key, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), key), key)
    return [(key, links[i], low[find(i)], key == low[find(i)]) for i, (key, _) in enumerate(rows)]


def crowd(rng, n, dims, noise):
    centre = rng.normal(size=dims)
    return [(centre + noise * rng.normal(size=dims)).tolist() for _ in range(n)]


def test_odd_vectors(spark):
    rng = np.random.default_rng(1)
    some = [v.tolist() for v in rng.normal(size=(20, 8))]
    rows = [*enumerate(some)]
    rows += [(100, some[3]), (101, [2 * x for x in some[3]]), (102, some[3]), (103, [-x for x in some[3]])]
    rows += [(200, None), (201, []), (202, [0.0] * 8), (203, [float("nan")] * 8), (204, [None, 1.0])]
    rows += [(205, [float("inf")] + [0.0] * 7), (206, [1e300] * 8), (207, [1e-300] * 8), (208, [1.0, 2.0]), (209, [1.0, 2.0])]
    df = spark.createDataFrame([(k, v, "x", "x") for k, v in rows], "vec_id bigint, embedding array<double>, item string, key string")
    got = sorted(tuple(r) for r in near_duplicates(df).collect())
    assert got == sorted(brute(rows))


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).collect() == []


def test_ids_that_repeat_or_are_null(spark):
    """Vectors of one id are one node, which joins what they are near to."""
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0]), (None, [1.0, 0.01])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    assert {(r.vec_id, r.component_id) for r in near_duplicates(df).collect()} == {(1, None), (2, None), (None, None)}


@pytest.mark.parametrize("block", [2048, 40])
def test_recall_on_crowds(spark, block):
    """Groups from two to hundreds, links near the border too, blocks of any size: recall 0.9, nothing false."""
    rng = np.random.default_rng(7)
    vectors = [v.tolist() for v in rng.normal(size=(600, 32))]
    for n, noise in ((300, 0.05), (60, 0.2), (30, 0.25), (5, 0.1), (2, 0.01)):
        vectors += crowd(rng, n, 32, noise)
    random.Random(1).shuffle(vectors)
    rows = list(enumerate(vectors))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    got = {r.vec_id: r for r in near_duplicates(df, block=block).collect()}
    wanted = brute(rows)
    assert all(got[k].n_links <= n for k, n, _, _ in wanted)
    assert sum(r.n_links for r in got.values()) >= 0.97 * sum(n for _, n, _, _ in wanted)
    alike = sum(got[k].component_id == c for k, _, c, _ in wanted)
    assert alike >= 0.95 * len(rows)


def test_query_recall(spark, small_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small_dir}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in op4_embedding_dedup(spark, small_dir).collect())
    assert got == sorted(brute(rows))


def test_description_is_ordered():
    rng = np.random.default_rng(3)
    rows, pivots = unit(rng.normal(size=(50, 6))), unit(rng.normal(size=(40, 6)))
    assert (nearest(rows, pivots, 7) == np.argsort(-(rows @ pivots.T), axis=1)[:, :7]).all()
    assert nearest(rows, pivots[:3], 7).shape == (50, 3)
    kept = spread(np.vstack([pivots, pivots + 1e-9]), 0.9)
    assert len(kept) <= 40 and (kept @ kept.T - np.eye(len(kept))).max() <= 0.9
