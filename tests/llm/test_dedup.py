from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from compare import connect, duck_rows, spark_rows
from tidemark.llm import dedup
from tidemark.llm.dedup import OP2_SQL, CuckooFilter, Shard, build_index, change_index, deduplicate, distinct_rows


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def expected(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault(lower(text), []).append(key)
    out = []
    for key, text in rows:
        same = groups[lower(text)]
        ids = [k for k in same if k is not None]
        keep = max(ids) if ids else None
        out.append((key, keep, len(same), key == keep, hashlib.sha256(lower(text).encode()).hexdigest()))
    return sorted(out, key=str)


def test_edge_rows(edge_docs, edge_rows):
    got = [tuple(r) for r in deduplicate(edge_docs).collect()]
    assert sorted(got, key=str) == expected([(k, t) for k, t, _ in edge_rows])


def test_distinct_rows(edge_docs, edge_rows):
    out = distinct_rows(edge_docs)
    assert out.columns == edge_docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    stay = {(k, keep) for k, keep, *_ in expected([(k, t) for k, t, _ in edge_rows]) if k == keep}
    assert len(got) == len({lower(t) for _, t, _ in edge_rows}) == len(stay)


def test_empty_table(no_docs):
    assert deduplicate(no_docs).collect() == [] and distinct_rows(no_docs).collect() == []


def test_query_equals_sql(spark, small_dir):
    con = connect(small_dir)
    assert spark_rows(dedup.op2_exact_dedup(spark, small_dir)) == duck_rows(con, OP2_SQL)


def digests(n, seed=0):
    rng = random.Random(seed)
    return [rng.randbytes(32) for _ in range(n)]


def test_filter_inserts_finds_and_deletes():
    some, others = digests(700), digests(2000, 1)
    table = CuckooFilter(256)
    assert all(table.insert(d) for d in some)
    assert all(d in table for d in some)
    assert sum(d in table for d in others) < 20
    assert all(table.delete(d) for d in some[:300])
    assert all(d in table for d in some[300:])
    assert sum(d in table for d in some[:300]) < 10


def test_full_filter_is_rebuilt_from_stored_keys():
    shard, keys = Shard(4), digests(5000)
    for i, d in enumerate(keys):
        shard.insert(d, 1, i, 1)
    assert shard.rebuilds and sorted(d for d, _ in shard.items()) == sorted(keys)
    shard.insert(keys[7], 2, 3, 1)
    assert dict(shard.items())[keys[7]] == (3, 7, 1)
    shard.delete(keys[7], 1)
    assert dict(shard.items())[keys[7]] == (2, 7, 1)
    shard.delete(keys[7], 2)
    assert keys[7] not in dict(shard.items())
    shard.delete(digests(1, 9)[0], 1)
    assert len(list(shard.items())) == 4999


def test_one_fingerprint_two_digests():
    """Equal in fingerprint and buckets: the stored digests tell them apart."""
    one = bytes(32)
    other = one[:20] + b"\1" * 12
    shard = Shard()
    shard.insert(one, 1, 1, 1)
    assert other in shard.filter
    shard.insert(other, 1, 2, 1)
    assert dict(shard.items()) == {one: (1, 1, 1), other: (1, 2, 1)}
    shard.delete(one, 1)
    assert dict(shard.items()) == {other: (1, 2, 1)} and other in shard.filter


def test_index_follows_documents(spark):
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.sha2((F.col("id") % 300).cast("string"), 256).cast("binary").alias("digest"))
    index = build_index(rows, keys_per_shard=50)
    later = change_index(index, rows.filter("doc_id < 10"), rows.filter("doc_id % 300 < 100"), shards=64)
    held = {bytes(r.digest): r.n for r in later.collect()}
    # Of the first hundred digests ten came back with one document, the rest went.
    assert sorted(held.values()) == [1] * 10 + [3] * 200
