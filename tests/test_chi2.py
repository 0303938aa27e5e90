"""Chi-squared statistic, tail and selection against ML."""

from __future__ import annotations

import os
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.feature import IDF, ChiSqSelector, CountVectorizerModel
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from tidemark.functions.special import chi2_tail
from tidemark.operators import chi2, terms
from tidemark.plans.training import Spec, select_features
from tidemark.schemas import WORDS
from tidemark.session import land

ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = []
    for i in range(240):
        label = rng.choice(["0", "4", "9"])
        lean = {"0": "bad", "4": "good", "9": "odd"}[label]
        words = [rng.choice([lean, lean, "the", "a", f"w{rng.randrange(15)}"]) for _ in range(rng.randrange(1, 12))]
        data.append((i, label, words))
    return spark.createDataFrame(data, f"doc_id long, label string, {WORDS} array<string>").persist()


def _ml(spark, rows, vocab):
    ordered = [r.term for r in vocab.orderBy("idx").collect()]
    tf = CountVectorizerModel.from_vocabulary(ordered, inputCol=WORDS, outputCol="tf").transform(rows)
    tf = tf.withColumn("y", F.col("label").cast("double"))
    return IDF(minDocFreq=5, inputCol="tf", outputCol="x").fit(tf).transform(tf)


def test_statistic_dof_and_p_value_equal_ml(spark, rows):
    vocab = land(terms.weighted_vocabulary(rows, 1, 100, rows.count(), 5), "vocab")
    found = terms.known_terms(rows, vocab, 1, ("label",))
    stats = chi2.chi2_stats(found, chi2.label_totals(rows))
    ours = {r.feature: r for r in chi2.chi2_select(stats, vocab, 100).collect()}
    tests = ChiSquareTest.test(_ml(spark, rows, vocab), "x", "y", flatten=True).collect()
    assert len(ours) == len(tests)
    for t in tests:
        mine = ours[t.featureIndex]
        assert mine.dof == t.degreesOfFreedom
        assert mine.statistic == pytest.approx(t.statistic, abs=1e-9)
        assert mine.p_value == pytest.approx(t.pValue, abs=1e-12)


@pytest.mark.parametrize("size", [1, 3, 8])
def test_selection_equals_ml(spark, rows, size):
    vocab = land(terms.weighted_vocabulary(rows, 1, 100, rows.count(), 5), "vocab")
    found = terms.known_terms(rows, vocab, 1, ("label",))
    chosen = chi2.chi2_select(chi2.chi2_stats(found, chi2.label_totals(rows)), vocab, size)
    ml = ChiSqSelector(numTopFeatures=size, featuresCol="x", labelCol="y").fit(_ml(spark, rows, vocab))
    assert sorted(r.feature for r in chosen.collect()) == sorted(ml.selectedFeatures)


def test_ties_go_to_the_lower_feature(spark):
    words = [["v", "w", "x", "y", "z"] if i % 2 else ["q"] for i in range(20)]
    rows = spark.createDataFrame(
        [(i, "4" if i % 2 else "0", w) for i, w in enumerate(words)],
        f"doc_id long, label string, {WORDS} array<string>",
    )
    vocab = land(terms.weighted_vocabulary(rows, 1, 10, 20, 1), "vocab")
    found = terms.known_terms(rows, vocab, 1, ("label",))
    chosen = chi2.chi2_select(chi2.chi2_stats(found, chi2.label_totals(rows)), vocab, 2)
    assert sorted(r.feature for r in chosen.collect()) == [0, 1]


def test_constant_feature_has_no_freedom(spark):
    rows = spark.createDataFrame(
        [(i, str(4 * (i % 2)), ["k"]) for i in range(6)], f"doc_id long, label string, {WORDS} array<string>"
    )
    vocab = land(terms.weighted_vocabulary(rows, 1, 10, 6, 1), "vocab")
    stats = chi2.chi2_stats(terms.known_terms(rows, vocab, 1, ("label",)), chi2.label_totals(rows))
    row = chi2.chi2_select(stats, vocab, 10).first()
    assert (row.statistic, row.dof, row.p_value) == (0.0, 0, 1.0)


def test_selection_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    train = docs.join(labels, "doc_id").select(F.col("text").alias("tweet"), F.col("quality").alias("target"))
    spec = Spec(vocab_size=300, top_features=120)
    results = [
        sorted(tuple(r) for r in select_features(train.repartition(parts), spec).chosen.collect()) for parts in (1, 5)
    ]
    assert results[0] == results[1] and len(results[0]) == 120


def test_tail_known_values(spark):
    cases = [(3.841458820694124, 1, 0.05), (18.307038053275146, 10, 0.05), (0.0, 3, 1.0), (124.34211340400407, 100, 0.05)]
    cases += [(1e6, 4, 0.0), (0.5, 2, float(np.exp(-0.25))), (5.0, 0, 1.0), (900.0, 1000, 0.9890), (1e9, 10**6, 0.0)]
    rows = spark.createDataFrame(cases, "x double, dof bigint, p double").withColumn("tail", chi2_tail("x", "dof"))
    for r in rows.collect():
        assert r.tail == pytest.approx(r.p, abs=1e-3 if r.dof == 1000 else 1e-12)


def test_many_labels_and_copies_of_tables(spark):
    """Cells are rows: a thousand labels need no thousand columns; equal tables tie."""
    rows = [(i, str(i % 1000), ["x", "y"] if i % 3 else ["z"]) for i in range(3000)]
    posts = spark.createDataFrame(rows, f"doc_id long, label string, {WORDS} array<string>")
    vocab = land(terms.weighted_vocabulary(posts, 1, 10, 3000, 1), "vocab")
    stats = chi2.chi2_stats(terms.known_terms(posts, vocab, 1, ("label",)), chi2.label_totals(posts))
    got = {r.feature: r for r in stats.collect()}
    table = np.array([[sum(i % 1000 == k and bool(i % 3) == side for i in range(k, 3000, 1000)) for k in range(1000)] for side in (True, False)])
    expected = table.sum(1, keepdims=True) * table.sum(0) / 3000
    assert got[0].statistic == got[1].statistic == pytest.approx(((table - expected) ** 2 / expected).sum(), abs=1e-6)
    assert got[0].dof == 999


def test_selection_runs_from_another_folder(tmp_path):
    """Workers need no path to this repository."""
    script = (
        f"import sys; sys.path.insert(0, {str(ROOT)!r});"
        "from tidemark.session import build_session; from tidemark.plans.catalog import chi2_stats;"
        "s = build_session(master='local[2]', **{'spark.ui.enabled': 'false', 'spark.sql.shuffle.partitions': '2',"
        "'spark.sql.adaptive.coalescePartitions.initialPartitionNum': '2'});"
        "print('rows', chi2_stats(s, '/root/testdata/sf0.001').count())"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows" in done.stdout, done.stderr[-2000:]
