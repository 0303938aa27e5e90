"""CSV source, label index, splits and evaluation scores."""

from __future__ import annotations

import subprocess
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tidemark.operators import evaluate, labels, split
from tidemark.session import CHECKPOINT_CONF, INPUT_TASKS_CONF, local_table, shared_dir
from tidemark.sources.tables import dealt
from tidemark.sources.readers import read_checked_csv, read_labelled_csv

ROOT = Path(__file__).resolve().parent.parent


def test_csv_edges(spark):
    path = Path(tempfile.mkdtemp(prefix="tidemark-csv-")) / "rows.csv"
    path.write_bytes(
        b'0,1,Mon,NO_QUERY,ann,"caf\xe9, ok"\n'
        b'4,2,Tue,NO_QUERY,bob,""\n'
        b"x,3,Wed,NO_QUERY,cy,bad target\n"
        b"4,4,Thu,NO_QUERY\n"
        b"4,5,Fri,NO_QUERY,eve,\n"
    )
    rows = {r.id: r for r in read_labelled_csv(spark, str(path)).collect()}
    assert rows["1"].tweet == "café, ok" and rows["1"].target == 0
    assert rows["2"].tweet is None and rows["5"].tweet is None
    assert rows["3"].target is None and rows["3"].tweet == "bad target"
    assert rows["4"].author is None and rows["4"].target == 4


def test_broken_csv_records_are_kept_apart(spark):
    path = Path(tempfile.mkdtemp(prefix="tidemark-csv-")) / "rows.csv"
    path.write_bytes(
        b'0,1,Mon,NO_QUERY,ann,"caf\xe9, ok"\n'
        b"x,3,Wed,NO_QUERY,cy,bad target\n"
        b"4,4,Thu,NO_QUERY\n"
        b"4,5,Fri,NO_QUERY,eve,a,b\n"
        b",6,Fri,NO_QUERY,eve,no target\n"
    )
    rows, broken = read_checked_csv(spark, str(path))
    plain = read_labelled_csv(spark, str(path))
    assert rows.columns == plain.columns and sorted(map(str, rows.collect())) == sorted(map(str, plain.collect()))
    assert sorted((r.reason, r.record) for r in broken.collect()) == [
        ("bad number", "x,3,Wed,NO_QUERY,cy,bad target"),
        ("number of fields", "4,4,Thu,NO_QUERY"),
        ("number of fields", "4,5,Fri,NO_QUERY,eve,a,b"),
    ]


def test_labels_sort_as_text_and_skip_null(spark):
    rows = spark.createDataFrame([(4,), (0,), (10,), (2,), (4,), (None,)], "target int")
    ours = {r.label: r.label_index for r in labels.label_index(rows).collect()}
    assert ours == {"0": 0.0, "10": 1.0, "2": 2.0, "4": 3.0}
    ml = StringIndexer(
        inputCol="target", outputCol="label", stringOrderType="alphabetAsc", handleInvalid="skip"
    ).fit(rows)
    assert list(ml.labels) == sorted(ours, key=ours.get)
    assert [r.target for r in labels.distinct_labels(rows.dropna(), "target").collect()] == [0, 2, 4, 10]


def test_display_names(spark):
    def named(values):
        rows = spark.createDataFrame([(v,) for v in values], "target int")
        return [(r.sentiment, r.display) for r in labels.describe_labels(labels.label_index(rows)).collect()]

    assert named([4, 0]) == [("Negative", "Negative (0)"), ("Positive", "Positive (4)")]
    assert named([0, 2, 4]) == [("Negative", "0 (0.0)"), ("Unknown", "2 (1.0)"), ("Positive", "4 (2.0)")]
    assert named([0, 1]) == [("Negative", "0 (0.0)"), ("Unknown", "1 (1.0)")]


def test_hash_split_is_stable_and_complete(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    results = []
    for parts in (1, 4, 8):
        train, test = split.hash_split(ids.repartition(parts), "doc_id")
        assert train.count() + test.count() == 20_000
        results.append(train.agg(F.sum("doc_id"), F.count("*")).first())
    assert results[0] == results[1] == results[2]
    assert 15_700 < results[0][1] < 16_300
    counts = {r.split: r.n for r in split.split_counts(split.with_split(ids, "doc_id")).collect()}
    assert counts["train"] == results[0][1]


def test_split_keeps_rows_without_key(spark):
    rows = spark.createDataFrame([(None,), ("a",), ("b",)], "id string")
    train, test = split.hash_split(rows, "id")
    assert train.count() + test.count() == 3


def test_samples(spark):
    ids = spark.range(10_000).withColumnRenamed("id", "doc_id")
    half = split.hash_sample(ids, "doc_id", 0.5, split.TRAIN_SAMPLE_SEED)
    other = split.hash_sample(ids, "doc_id", 0.5, split.TEST_SAMPLE_SEED)
    assert 4_700 < half.count() < 5_300
    assert 2_200 < half.join(other, "doc_id").count() < 2_800
    assert split.hash_sample(ids, "doc_id", 0.0, 1).count() == 0
    assert split.hash_sample(ids, "doc_id", 1.0, 1).count() == 10_000


def test_metrics_fixture(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select(
        F.col("quality").alias("label"), (1 - F.col("toxic")).alias("prediction")
    )
    row = evaluate.eval_metrics(evaluate.confusion_counts(rows)).first()
    assert row.accuracy == pytest.approx(0.7719298246, abs=1e-9)
    assert row.weighted_precision == pytest.approx(0.7599521962, abs=1e-9)
    assert row.weighted_recall == pytest.approx(0.7719298246, abs=1e-9)
    assert row.f1 == pytest.approx(0.7657650271, abs=1e-9)


def test_metrics_equal_ml_with_a_class_never_predicted(spark):
    pairs = [(0.0, 0.0)] * 5 + [(1.0, 0.0)] * 3 + [(2.0, 2.0)] * 4 + [(2.0, 0.0)] + [(0.0, 3.0)] * 2
    rows = spark.createDataFrame(pairs, "label double, prediction double")
    ours = evaluate.eval_metrics(evaluate.confusion_counts(rows)).first().asDict()
    names = {
        "accuracy": "accuracy",
        "weighted_precision": "weightedPrecision",
        "weighted_recall": "weightedRecall",
        "f1": "f1",
    }
    for ours_name, ml_name in names.items():
        ml = MulticlassClassificationEvaluator(metricName=ml_name).evaluate(rows)
        assert ours[ours_name] == pytest.approx(ml, abs=1e-12)


def test_confusion_matrix_is_dense_over_the_label_set(spark):
    rows = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (1.0, 0.0)], "label double, prediction double")
    counts = evaluate.confusion_counts(rows)
    known = local_table(spark, [(0.0,), (1.0,), (2.0,)], ("label",))
    cells = [tuple(r) for r in evaluate.confusion_matrix(counts, known).collect()]
    assert len(cells) == 9 and cells[0] == (0.0, 0.0, 1) and cells[3] == (1.0, 0.0, 2)
    assert [tuple(r) for r in evaluate.confusion_matrix(counts).collect()] == [
        (0.0, 0.0, 1),
        (0.0, 1.0, 0),
        (1.0, 0.0, 2),
        (1.0, 1.0, 0),
    ]


def test_session_helpers(spark):
    rows = spark.range(10)
    assert dealt(rows) is rows
    spark.conf.set(INPUT_TASKS_CONF, "3")
    try:
        assert dealt(rows).rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset(INPUT_TASKS_CONF)
    assert shared_dir(spark) == shared_dir(spark)


def test_local_tables_have_their_size(spark):
    """Catalyst knows the size, so a long table is not broadcast."""
    table = local_table(spark, [(i, "x") for i in range(400_000)], ("k", "v"))
    plan = spark.range(10**7).join(table, F.col("id") == F.col("k"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    few = local_table(spark, [(1, "x")], ("k", "v"))
    assert "BroadcastHashJoin" in spark.range(10**7).join(few, F.col("id") == F.col("k"))._jdf.queryExecution().executedPlan().toString()


def test_too_many_classes_are_refused(spark):
    counts = evaluate.confusion_counts(spark.range(30).selectExpr("double(id) as label", "double(id) as prediction"))
    with pytest.raises(ValueError, match="most_classes"):
        evaluate.confusion_matrix(counts, most_classes=20)


def test_shared_dir_is_the_configured_one():
    """In a process of its own, because the setting is fixed per context."""
    script = (
        "from tidemark.session import build_session, cleanup, fresh_path, land, run_dir;"
        f"s = build_session(master='local[1]', **{{'{CHECKPOINT_CONF}': '/tmp/named-by-the-cluster/'}});"
        "print('at', fresh_path(s, 'x'));"
        "t = land(s.range(3), 'y'); print('rows', t.count()); cleanup(s);"
        "import pathlib; print('left', pathlib.Path(run_dir(s)).exists())"
    )
    done = subprocess.run([sys.executable, "-c", script], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert "at /tmp/named-by-the-cluster/tidemark-" in done.stdout
    assert "rows 3" in done.stdout and "left False" in done.stdout
