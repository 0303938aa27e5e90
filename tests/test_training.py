"""Fitting: parity with the declared pipeline, optimality, saving, quarantine."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    IDF,
    ChiSqSelector,
    CountVectorizer,
    NGram,
    StringIndexer,
    StringIndexerModel,
    Tokenizer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array

from tidemark.operators.labels import split_usable
from tidemark.plans import training
from tidemark.plans.training import Spec
from tidemark.schemas import CLEANED
from tidemark.session import fresh_path
from tidemark.sources.tables import labelled
from tidemark.sources.writers import load_model, save_model

GOOD = ["what a great day", "love this great phone", "really love it", "great great stuff here"]
BAD = ["what a bad day", "hate this awful phone", "really hate it", "awful bad stuff here"]


@pytest.fixture(scope="module")
def toy(spark):
    rows = [(i, 4 if i % 2 else 0, (GOOD if i % 2 else BAD)[i // 2 % 4]) for i in range(64)]
    return spark.createDataFrame(rows, "doc_id long, target int, tweet string").persist()


@pytest.fixture(scope="module")
def train(spark):
    return labelled(spark, "/root/testdata/sf0.01").select("doc_id", "target", "tweet").persist()


TOY = Spec(vocab_size=200, top_features=600, min_doc_freq=2, max_iter=100)


@pytest.fixture(scope="module")
def toy_model(toy):
    return training.fit(toy, TOY)


def plain_pipeline(spec):
    """The job as plain ML stages, for comparison: the parameters are the fixed ones of Spec."""
    numbers = (1, 2, 3)
    return Pipeline(
        stages=[
            training.cleaner(spec),
            Tokenizer(inputCol=CLEANED, outputCol="tokens"),
            *[NGram(n=n, inputCol="tokens", outputCol=f"grams{n}") for n in numbers],
            *[CountVectorizer(vocabSize=spec.vocab_size, inputCol=f"grams{n}", outputCol=f"counts{n}") for n in numbers],
            *[IDF(minDocFreq=spec.min_doc_freq, inputCol=f"counts{n}", outputCol=f"weights{n}") for n in numbers],
            VectorAssembler(inputCols=[f"weights{n}" for n in numbers], outputCol="everything"),
            StringIndexer(inputCol=spec.target, outputCol="label", stringOrderType="alphabetAsc"),
            ChiSqSelector(
                numTopFeatures=spec.top_features, featuresCol="everything", labelCol="label", outputCol="features"
            ),
            training.solver(spec),
        ]
    )


def test_default_parameters():
    spec = Spec()
    assert (spec.max_n, spec.vocab_size, spec.min_doc_freq, spec.top_features) == (3, 16384, 5, 16384)
    solver = training.solver(spec)
    assert (solver.getRegParam(), solver.getElasticNetParam(), solver.getMaxIter()) == (0.1, 0.0, 1000)


def test_stages_tell_what_they_hold(spark, toy, toy_model):
    listed = training.describe_stages(spark, toy_model.stages).orderBy("position").collect()
    assert [r.stage for r in listed][:5] == ["SQLTransformer", "Tokenizer", "NGram", "CountVectorizerModel", "ElementwiseProduct"]
    assert listed[-1].stage == "LogisticRegressionModel"
    kept = sum(r["size"] for r in listed if r.stage == "CountVectorizerModel")
    assert listed[-1]["size"] == kept and listed[-2]["size"] == 2
    assert (listed[2].inputs, listed[2].output) == ("words", "1_grams")
    assert (listed[-2].inputs, listed[-2].output) == ("target", "label")
    assert (listed[-1].inputs, listed[-1].output) == ("features", "prediction")


def test_fit_equals_plain_pipeline(toy, toy_model):
    """Same probabilities as the plain ML pipeline when no vocabulary is cut."""
    plain = plain_pipeline(TOY).fit(toy)
    p = vector_to_array("probability").getItem(1)
    ours = {r.doc_id: r.p for r in toy_model.transform(toy).select("doc_id", p.alias("p")).collect()}
    theirs = {r.doc_id: r.p for r in plain.transform(toy).select("doc_id", p.alias("p")).collect()}
    assert ours.keys() == theirs.keys()
    assert all(ours[k] == pytest.approx(theirs[k], abs=1e-5) for k in ours)


def test_separable_set_is_learned(toy, toy_model):
    metrics, matrix = training.evaluate(toy_model, toy)
    assert metrics.first().asDict() == {
        "accuracy": 1.0,
        "weighted_precision": 1.0,
        "weighted_recall": 1.0,
        "f1": 1.0,
    }
    assert [tuple(r) for r in matrix.collect()] == [(0.0, 0.0, 32), (0.0, 1.0, 0), (1.0, 0.0, 0), (1.0, 1.0, 32)]


def test_scoring_needs_no_label_and_keeps_columns(spark, toy_model):
    rows = spark.createDataFrame([("x", "love great", 7)], "id string, tweet string, other int")
    out = toy_model.transform(rows)
    assert {"id", "other", "words", "1_grams", "2_grams", "3_tfidf", "rawPrediction", "probability"} <= set(out.columns)
    assert "label" not in out.columns
    assert out.first().prediction == 1.0


def test_save_and_load(spark, toy, toy_model):
    path = fresh_path(spark, "model")
    save_model(toy_model, path)
    save_model(toy_model, path)
    again = load_model(path)
    before = sorted(tuple(r) for r in toy_model.transform(toy).select("doc_id", "prediction").collect())
    after = sorted(tuple(r) for r in again.transform(toy).select("doc_id", "prediction").collect())
    assert before == after


def test_label_dictionary_of_a_fit(spark, toy, toy_model):
    labels = training.select_features(toy, TOY).labels
    rows = [tuple(r) for r in training.describe_fitted_labels(spark, labels).collect()]
    assert rows == [("0", 0.0, 32, "Negative", "Negative (0)"), ("4", 1.0, 32, "Positive", "Positive (4)")]
    index = [s for s in toy_model.stages if isinstance(s, StringIndexerModel)]
    assert index[0].labels == ["0", "4"]


def test_full_output_holds_all_term_vectors(toy, toy_model):
    """The same predictions, and the vectors of the whole vocabulary next to them."""
    spec = replace(TOY, top_features=12, full=True)
    full, compact = training.fit(toy, spec), training.fit(toy, replace(TOY, top_features=12))
    out = full.transform(toy)
    row = out.first()
    assert row.rawFeatures.size == row["1_tfidf"].size + row["2_tfidf"].size + row["3_tfidf"].size > row.features.size == 12
    ours = sorted((r.doc_id, r.probability.toArray().tolist()) for r in out.collect())
    theirs = sorted((r.doc_id, r.probability.toArray().tolist()) for r in compact.transform(toy).collect())
    assert [k for k, _ in ours] == [k for k, _ in theirs]
    assert np.allclose([p for _, p in ours], [p for _, p in theirs], atol=1e-6)


def test_gradient_in_long_form(train):
    """Near 0 at the solution, and not elsewhere."""
    spec = Spec(vocab_size=150, top_features=200)
    selection = training.select_features(train, spec)
    model = training.fit_selected(train, selection, spec)
    rows = {r.n: r for r in training.gradient(train, model, selection, spec).collect()}
    assert sum(r.features for r in rows.values()) == 200
    assert all(r.largest < 2e-3 for r in rows.values())
    early = training.fit_selected(train, selection, replace(spec, max_iter=1))
    assert max(r.largest for r in training.gradient(train, early, selection, spec).collect()) > 2e-3


def test_unseen_label_is_an_error(spark, toy_model):
    rows = spark.createDataFrame([(9, "love")], "target int, tweet string")
    with pytest.raises(Exception, match="9"):
        toy_model.transform(rows).select("label").collect()


def test_unusable_rows_are_set_aside(spark, toy):
    extra = spark.createDataFrame([(900, None, "x"), (901, 4, None)], "doc_id long, target int, tweet string")
    mixed = toy.unionByName(extra)
    good, bad = split_usable(mixed, "tweet", "target")
    assert good.count() == 64 and sorted(r.doc_id for r in bad.collect()) == [900, 901]
    assert training.fit(mixed, TOY).transform(toy).count() == 64


def test_nothing_to_train_on_is_an_error(spark, toy):
    with pytest.raises(ValueError, match="no row"):
        training.fit(toy.filter("target > 9"), TOY)


def test_selected_vectors_equal_selection_of_full_vectors(spark, train):
    """The compact stages give the vectors of all features, cut to the selected."""
    spec = Spec(vocab_size=250, top_features=90)
    everything = training.select_features(train, Spec(vocab_size=250, top_features=750))
    cut = training.select_features(train, spec)
    full_stages = training.feature_stages(everything, spec)
    cut_stages = training.feature_stages(cut, spec)
    order = [r.feature for r in everything.chosen.orderBy("feature").collect()]
    keep = sorted(order.index(r.feature) for r in cut.chosen.collect())
    assert len(keep) == 90

    def vectors(stages):
        out = training.PipelineModel(stages).transform(train)
        return {r.doc_id: r.features.toArray() for r in out.select("doc_id", "features").collect()}

    full, cut = vectors(full_stages), vectors(cut_stages)
    assert all(np.array_equal(full[k][keep], cut[k]) for k in full)


def test_solution_is_optimal(train):
    """The gradient of the regularised loss, in standardised space, is near 0."""
    spec = Spec(vocab_size=150, top_features=200)
    model = training.fit(train, spec)
    rows = model.transform(train).select("label", "features").collect()
    y = np.array([r.label for r in rows])
    x = np.array([r.features.toArray() for r in rows])
    lr = model.stages[-1]
    w, b = lr.coefficients.toArray(), lr.intercept
    sd = x.std(axis=0, ddof=1)
    used = sd > 0
    error = 1 / (1 + np.exp(-(x @ w + b))) - y
    scaled = x[:, used] / sd[used]
    gradient = scaled.T @ error / len(y) + spec.reg_param * w[used] * sd[used]
    assert np.abs(gradient).max() < 2e-3
    assert abs(error.mean()) < 1e-3
    assert np.all(w[~used] == 0)
