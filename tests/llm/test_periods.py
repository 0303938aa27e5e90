from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings, strategies as st

from tidemark.llm.periods import collapsed, find_runs, op11_period_runs, runs_of, runs_of_texts


def smallest_period(words):
    fail = [0] * len(words)
    for i in range(1, len(words)):
        k = fail[i - 1]
        while k and words[i] != words[k]:
            k = fail[k - 1]
        fail[i] = k + (words[i] == words[k])
    return len(words) - fail[-1]


def brute_runs(words, least=12):
    """Every period on every place."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j - i + q >= least and smallest_period(words[i : j + q]) == q:
                out.append((i, j + q - i, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(key, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(key).encode() if key is not None else b"")
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return key, len(runs), *told, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def ids_of(words):
    return np.array([*words, max(words, default=0) + 1], np.int64)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60))
def test_runs_of_few_letters(words):
    assert sorted(runs_of(ids_of(words))) == sorted(brute_runs(words, least=2))


def test_runs_of_repetitive_words():
    rng = random.Random(3)
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < 300:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    samples = [[7] * 200, fibonacci[-1], [i // 3 for i in range(90)] * 4, [0, 1] * 50 + [0, 0] + [1, 0] * 50]
    for _ in range(60):
        root = [rng.randrange(4) for _ in range(rng.randint(1, 20))]
        samples.append([rng.randrange(3) for _ in range(rng.randint(0, 30))] + root * rng.randint(2, 6) + root[: rng.randint(0, len(root))])
    for words in samples:
        assert sorted(runs_of(ids_of(words))) == sorted(brute_runs(words, least=2))
    texts = [[b"w%d" % w for w in words] for words in samples] + [[]]
    assert runs_of_texts(texts, 12) == [brute_runs(words) for words in texts]


def test_a_long_uniform_text_is_fast():
    words = [b"from"] * 300_000 + [b"x"] + [b"a", b"b", b"c"] * 50_000
    assert runs_of_texts([words], 12) == [[(0, 300_000, 1), (300_001, 150_000, 3)]]
    assert collapsed(words, [(0, 300_000, 1), (300_001, 150_000, 3)]) == b"from x a b c"


def digest_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_documents(spark, small_dir, small_docs):
    df = op11_period_runs(spark, small_dir)
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert df.columns == columns
    assert [t for c, t in df.dtypes if c in columns[:6]] == ["bigint"] * 6
    rows = [(r.doc_id, r.text) for r in small_docs.collect() if len(r.text or "") < 20_000]
    known = {k for k, _ in rows}
    assert [r for r in digest_rows(df) if r[0] in known] == sorted((brute(*r) for r in rows), key=str)
    assert df.count() == small_docs.count() and df.filter("n_runs > 0").count() > 10


def test_edge_rows(edge_docs, edge_rows):
    got = find_runs(edge_docs).collect()
    assert len(got) == len(edge_rows)
    want = {}
    for key, text, _ in edge_rows:
        words = (text or "").encode().split()
        if len(words) < 1000:
            runs = brute_runs(words)
            want.setdefault(key, []).append((len(words), runs, collapsed(words, runs).decode()))
    for key, wanted in want.items():
        rows = [(r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got if r.doc_id == key]
        assert sorted(rows) == sorted(wanted)


def test_empty_table_and_short_runs(spark, no_docs):
    assert find_runs(no_docs).collect() == []
    docs = spark.createDataFrame([(1, "a b a b a b a b a b a"), (2, "a b a b a b a b a b a b")], "doc_id bigint, text string")
    assert {r.doc_id: [tuple(x) for x in r.runs] for r in find_runs(docs).collect()} == {1: [], 2: [(0, 12, 2)]}
