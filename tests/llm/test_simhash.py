from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash
from tidemark.llm.graph import Forest, components
from tidemark.llm.simhash import compare, near_groups, one_per_group, op8_simhash, population, simhash_groups

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_print(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, radius=2):
    """Smallest key reachable over all pairs of (key, fingerprint)."""
    parent = {k: k for k, _ in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (k, p) in enumerate(prints):
        for m, q in prints[:i]:
            if bin(p ^ q).count("1") <= radius:
                a, b = find(k), find(m)
                parent[max(a, b)] = min(a, b)
    return {k: find(k) for k, _ in prints}


def test_edge_rows(edge_docs, edge_rows):
    got = simhash_groups(edge_docs).collect()
    told = sorted(((k if k is not None else -1, plain_print(t)) for k, t, _ in edge_rows))
    wanted = groups(sorted(set(told)))
    assert sorted((r.doc_id if r.doc_id is not None else -1, int(r.fingerprint, 16)) for r in got) == told
    for r in got:
        key = r.doc_id if r.doc_id is not None else -1
        assert (r.component_id if r.component_id is not None else -1) == wanted[key]


def test_one_per_group(edge_docs):
    rows = simhash_groups(edge_docs).collect()
    out = one_per_group(edge_docs)
    assert out.columns == edge_docs.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted({str(r.component_id) for r in rows})


def test_empty_table(no_docs):
    assert simhash_groups(no_docs).collect() == [] and one_per_group(no_docs).collect() == []


def test_query(spark, small_dir, small_docs):
    told = sorted((r.doc_id, plain_print(r.text)) for r in small_docs.collect())
    wanted = groups(told)
    rows = sorted(tuple(r) for r in op8_simhash(spark, small_dir).collect())
    assert rows == [(k, f"{p:016x}", wanted[k]) for k, p in told]


@pytest.mark.parametrize("tile_size", [7, 64, 4096])
def test_chains_over_many_tiles(spark, tile_size):
    """Fingerprints a step apart form chains; tiles of any size find them all."""
    rng = np.random.default_rng(2)
    prints = []
    for _ in range(40):
        at = int(rng.integers(0, 1 << 63))
        for _ in range(int(rng.integers(1, 9))):
            prints.append(at)
            at ^= (1 << int(rng.integers(0, 63))) | (1 << int(rng.integers(0, 63)))
    rows = [(int(k), p) for k, p in zip(rng.permutation(len(prints)), prints)]
    wanted = groups(sorted(rows))
    df = spark.createDataFrame(rows, "doc bigint, print bigint")
    got = {r.print: r.component for r in near_groups(df, tile_size=tile_size).collect()}
    assert all(got[p] == wanted[k] for k, p in rows)


def test_skipped_tiles_hold_no_links():
    rng = np.random.default_rng(4)
    prints = rng.integers(-(1 << 62), 1 << 62, 400)
    counts = population(prints)
    assert (counts.sum(axis=1) == [bin(int(p) % (1 << 64)).count("1") for p in prints]).all()
    near = prints ^ (1 << 5) ^ (1 << 60)
    assert np.abs(population(near) - counts).sum(axis=1).max() <= 2
    forest = compare(prints, near, 2, same=False)
    assert all(forest.find(400 + i) == forest.find(i) for i in range(400))


def test_long_text_in_runs(monkeypatch):
    text = " ".join(f"w{i * i % 1009}" for i in range(3000)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 255)
    assert simhash.fingerprint(text) == whole == int.from_bytes(plain_print(text.decode()).to_bytes(8, "big"), "big", signed=True)


def test_components(spark):
    rng = np.random.default_rng(6)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)] + [(2000, 2001 + i) for i in range(50)]
    forest = Forest(3000)
    for a, b in edges:
        forest.join(a, [b])
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == dict(forest.edges())
    assert components(spark.range(0).select(F.col("id").alias("a"), F.col("id").alias("b"))).collect() == []
