from __future__ import annotations

import collections
import math
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_model as lm
from tidemark.llm.common import raw_text, remainder
from tidemark.session import run_dir


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def held(key):
    return key is not None and zlib.crc32(str(key).encode()) % 7 == 2


def check(rows, docs, how=held):
    counts = collections.Counter(w for k, t in docs if not how(k) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    wanted = sorted(
        (str(k), how(k), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n,
         sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)))
        for k, t in docs
    )
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows)
    assert [g[:5] for g in got] == [w[:5] for w in wanted]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in wanted], rel=1e-9)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in rows)


def test_query(spark, small_dir, small_docs):
    check(lm.op5_lm_scoring(spark, small_dir).collect(), [(r.doc_id, r.text) for r in small_docs.collect()])


def test_held_out_texts_are_likelier_than_by_the_base(spark):
    apart = lm.op5_lm_scoring(spark, "/root/testdata/sf0.01").filter("held_out").collect()
    assert sum(r.score for r in apart) > 0.98 * sum(r.base_score for r in apart)


@pytest.mark.parametrize("most_words", [1 << 18, 40, 0])
def test_exact_counts_with_few_common_words(small_docs, most_words):
    """Whatever is broadcast, the base scores are the same; questions are split into chunks."""
    rows = lm.score_documents(small_docs, remainder("doc_id", 7) == 2, most_words=most_words, docs_at_once=30, tokens_at_once=5000, bytes_per_bucket=1000).collect()
    check(rows, [(r.doc_id, r.text) for r in small_docs.collect()])


def test_edge_rows(edge_docs, edge_rows):
    rows = lm.score_documents(edge_docs, remainder("doc_id", 7) == 2).collect()
    check(rows, [(k, t) for k, t, _ in edge_rows])


def test_empty_and_untrained(no_docs, edge_docs, edge_rows):
    assert lm.score_documents(no_docs, F.lit(True)).collect() == []
    check(lm.score_documents(edge_docs, F.lit(True)).collect(), [(k, t) for k, t, _ in edge_rows], how=lambda k: True)


def slice_levels(sliced, kind, keys, bits=6):
    """Levels that each key's slice of the filter tells."""
    slices = {r.bucket: np.frombuffer(bytes(r.slice), np.uint8) for r in sliced.filter(F.col("kind") == kind).collect()}
    out = np.zeros(len(keys), np.int64)
    buckets = (keys >> np.uint64(64 - bits)).astype(np.int64)
    for bucket, data in slices.items():
        own = buckets == bucket
        out[own] = lm.probed_levels(data, 0, np.uint64(8 * len(data)), keys[own], 1)
    return out


def test_filter_gives_the_quantised_counts(small_docs):
    """No count is lost or too low, and few are too high."""
    _, sliced = lm.train(small_docs.select(raw_text("text").alias("text")), 6, tokens_at_once=50_000)
    words = [tokens(r.text) for r in small_docs.collect()]
    single = collections.Counter(w for own in words for w in own)
    known = lm.WordKeys()
    keys = np.array([known[w] for w in single], np.uint64)
    true = lm.level_of(np.array(list(single.values())))
    got = slice_levels(sliced, lm.UNIGRAM, keys)
    assert (got >= true).all() and (got > true).mean() < 0.05
    pairs = collections.Counter(p for own in words for p in zip([b"\n", *own], own))
    left = np.array([known[a] for a, _ in pairs], np.uint64)
    right = np.array([known[b] for _, b in pairs], np.uint64)
    both = np.array([lm.bigram_keys(np.array([a, b], np.uint64))[1] for a, b in zip(left, right)], np.uint64)
    true = lm.level_of(np.array(list(pairs.values())))
    got = slice_levels(sliced, lm.BIGRAM, both)
    assert (got >= true).all() and (got > true).mean() < 0.05
    rng = np.random.default_rng(1)
    absent = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    assert (slice_levels(sliced, lm.BIGRAM, absent) > 0).mean() < 0.05


def test_sorted_keys_come_back():
    rng = np.random.default_rng(2)
    for keys in (np.zeros(0, np.uint64), np.array([0, 0, 2**64 - 1], np.uint64), np.sort(rng.integers(0, 1 << 63, 999, dtype=np.uint64) * np.uint64(2))):
        data = lm.packed_sorted(keys)
        assert (lm.unpacked_sorted(data) == keys).all() and len(lm.unpacked_sorted(data)) == len(keys)


def test_levels():
    counts = np.arange(1, 5000)
    levels = lm.level_of(counts)
    assert levels[0] == 1 and (np.diff(levels) >= 0).all()
    for level in np.unique(levels):
        own = counts[levels == level]
        if own.max() < 4999:
            assert own.min() <= lm.LEVEL_COUNT[level] <= own.max()


@pytest.mark.parametrize("most_words, most_pairs", [(40, 1 << 20), (1 << 18, 30), (0, 0)])
def test_scores_do_not_depend_on_what_is_broadcast(small_docs, most_words, most_pairs):
    """All entries of the filter are asked, wherever they are held."""

    def scores(**how):
        rows = lm.score_documents(small_docs, remainder("doc_id", 7) == 2, **how).collect()
        return [s for _, s in sorted((r.doc_id, r.score) for r in rows)]

    bounded = scores(most_words=most_words, most_pairs=most_pairs, docs_at_once=30, asked_at_once=5000)
    assert bounded == pytest.approx(scores(docs_at_once=30, asked_at_once=5000), rel=1e-12)


def test_slices_hold_all_entries(small_docs):
    """The slices together are as large as the entries ask for, however many there are."""
    texts = small_docs.select(raw_text("text").alias("text"))
    model, sliced = lm.train(texts, 6, most_words=10, most_pairs=10)
    held = lm.level_totals(sliced)
    lowest = [int(held[k].nonzero()[0].min()) for k in (0, 1)]
    entries = sum(int((held[k] * np.maximum(np.arange(lm.LEVELS) - lowest[k] + 1, 0)).sum()) for k in (0, 1))
    size = sum(len(r.slice) for r in sliced.select("slice").collect())
    assert size >= entries * 10 / 8 and max(map(len, model.keys)) <= 10


def exact_scores(docs, least=2, rounds=20):
    """Scores by dictionaries, shares fitted token by token on all training texts."""
    train = [tokens(t) for k, t in docs if not held(k)]
    single = collections.Counter(w for own in train for w in own)
    pairs = collections.Counter(p for own in train for p in zip([b"\n", *own], own))
    size = sum(single.values()) + len(single) + 1

    def level(n):
        return int(lm.level_of(np.array([n]))[0]) if n else 0

    def middle(n, less):
        return max(float(lm.LEVEL_COUNT[level(n)]) - less, 0)

    def parts(own, less):
        for a, b in zip([b"\n", *own], own):
            both = pairs[a, b] if pairs[a, b] >= least else 0
            context = middle(single[a], less)
            after = min(middle(both, less), context) / context if context else 0.0
            yield level(single[a]), after, (middle(single[b], less) + 1) / size

    seen = [x for own in train for x in parts(own, 1.0)]
    n = collections.Counter(x[0] for x in seen)
    shares = collections.defaultdict(lambda: 0.5)
    for _ in range(rounds):
        due = collections.Counter()
        for before, after, alone in seen:
            pair = shares[before] * after
            due[before] += pair / (pair + (1 - shares[before]) * alone)
        shares = collections.defaultdict(float, {q: due[q] / (n[q] + 1) for q in n})
    shares = collections.defaultdict(float, {q: min(x, 0.999) if q else 0.0 for q, x in shares.items()})
    return {k: sum(math.log10(shares[q] * x + (1 - shares[q]) * y) for q, x, y in parts(tokens(t), 0.0)) for k, t in docs}


@pytest.fixture
def skewed_texts():
    rng = np.random.default_rng(2)
    docs = []
    for k in range(60):
        at = rng.zipf(1.4, 4000 if k % 10 == 0 else 40) % 300
        docs.append((k, " ".join(f"w{a} v{a}" if a % 3 else f"w{a}" for a in at)))
    return docs


@pytest.mark.parametrize("split", [1, 7])
def test_shares_are_fitted_on_all_texts(spark, skewed_texts, split):
    """Long texts and rare levels take part, and the scores do not depend on the layout."""
    df = spark.createDataFrame(skewed_texts, "doc_id bigint, text string").repartition(split)
    # Sparse bits: hardly a false level.
    rows = lm.score_documents(df, remainder("doc_id", 7) == 2, bits_per_entry=200, least=(1, 2)).collect()
    wanted = exact_scores(skewed_texts)
    assert {r.doc_id: r.score for r in rows} == pytest.approx(wanted, rel=1e-6)


@pytest.mark.parametrize("passes", [1, 3])
def test_answered_questions_leave_the_disks(spark, small_docs, passes):
    """Questions and waiting tokens are deleted once read; scores do not depend on the passes."""
    how = dict(docs_at_once=30, asked_at_once=5000, most_words=40, most_pairs=30)
    before = set(Path(run_dir(spark).removeprefix("file:")).glob("lm-*"))
    rows = lm.score_documents(small_docs, remainder("doc_id", 7) == 2, passes=passes, **how).collect()
    new = set(Path(run_dir(spark).removeprefix("file:")).glob("lm-*")) - before
    left = {part.name.removeprefix("part=") for table in new for part in table.glob("part=*")}
    assert left == {"docs", "cells", "sums"} and len([t for t in new if t.name.startswith("lm-pairs")]) == passes
    wanted = lm.score_documents(small_docs, remainder("doc_id", 7) == 2, **how).collect()
    assert {r.doc_id: r.score for r in rows} == pytest.approx({r.doc_id: r.score for r in wanted}, rel=1e-12)


def test_pairs_seen_once_are_held(spark, skewed_texts):
    df = spark.createDataFrame(skewed_texts, "doc_id bigint, text string")
    rows = lm.score_documents(df, remainder("doc_id", 7) == 2, bits_per_entry=200).collect()
    wanted = exact_scores(skewed_texts, least=1)
    assert {r.doc_id: r.score for r in rows} == pytest.approx(wanted, rel=1e-6)
    assert wanted != pytest.approx(exact_scores(skewed_texts, least=2), rel=1e-6)
