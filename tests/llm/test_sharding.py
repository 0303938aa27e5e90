from __future__ import annotations

import zlib

import pytest

from tidemark.llm import sharding
from tidemark.llm.sharding import assign_shards, op1_sharding


def placed(df):
    return [r.asDict() for r in df.collect()]


def check(rows, texts, shards):
    """Every row once, gapless slots, and sizes and checksums of the texts."""
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == sorted(
        (str(k), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for k, t in texts
    )
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(0 <= s < shards for s in slots)
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())


def test_edge_rows(edge_docs, edge_rows):
    rows = placed(assign_shards(edge_docs, 3, ranges_per_shard=2))
    check(rows, [(k, t) for k, t, _ in edge_rows], 3)


def test_empty_table(no_docs):
    assert placed(assign_shards(no_docs)) == []


def test_sizes_are_near_equal(spark, small_dir, small_docs):
    df = op1_sharding(spark, small_dir)
    assert {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"} <= set(df.columns)
    rows = placed(df)
    check(rows, [(r.doc_id, r.text) for r in small_docs.collect()], 24)
    sums = {}
    for r in rows:
        sums[r["shard"]] = sums.get(r["shard"], 0) + r["size"]
    mean = sum(sums.values()) / 24
    longest = max(r["size"] for r in rows)
    assert all(abs(v - mean) <= longest + 0.02 * mean for v in sums.values())
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}


@pytest.mark.parametrize("hot", ["text", "doc_id"])
def test_hot_group_is_cut(spark, hot):
    """A third of the rows are copies, by text or by doc_id and text: shards stay equal, other copies together."""
    same = "'the same text for all of these'"
    rows = spark.range(3000).selectExpr(
        f"if(id % 3 = 0 and '{hot}' = 'doc_id', 0, id) as doc_id",
        f"if(id % 3 = 0, {same}, concat('text ', cast(id % 500 as string), ' ', repeat('x', cast(id % 90 as int)))) as text",
    )
    out = placed(assign_shards(rows, 6))
    texts = [(r.doc_id, r.text) for r in rows.collect()]
    check(out, texts, 6)
    sums = [sum(r["size"] for r in out if r["shard"] == s) for s in range(6)]
    assert max(sums) - min(sums) <= 0.05 * sum(sums) / 6
    by_crc = {}
    for r in out:
        by_crc.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert sum(len(s) > 1 for s in by_crc.values()) <= 6


def test_search_finds_the_range(spark):
    cuts = [(1, 0, 0), (5, 9, 0), (5, 2, 0), (7, 0, 0), (5, 2, 0)]
    keys = [(0, 0), (1, 0), (4, 9), (5, 1), (5, 2), (5, 9), (6, 0), (7, 0), (9, 9)]
    rows = spark.createDataFrame(keys, "k bigint, r bigint").selectExpr("struct(k, r, cast(0 as bigint) as t) as key")
    got = [r[0] for r in rows.select(sharding.range_of(cuts, rows.key)).collect()]
    assert got == [0, 1, 1, 1, 2, 3, 3, 4, 4]


def test_no_python_in_the_plan(spark, small_dir):
    plan = op1_sharding(spark, small_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
