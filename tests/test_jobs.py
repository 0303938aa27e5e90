"""The command-line jobs, from search plan to scored collections."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidemark.__main__ import main
from tidemark.schemas import LABELLED
from tidemark.session import fresh_path
from tidemark.sources import readers, writers


def test_plan_job(spark):
    out = fresh_path(spark, "plan")
    main(["plan", "--out", out, "--start", "2025-03-18", "--end", "2025-03-19", "--keyword", "a b:t-1"])
    rows = spark.read.parquet(out).orderBy("since").collect()
    assert [r.query for r in rows] == [
        '"a b" lang:en since:2025-03-18 until:2025-03-19',
        '"a b" lang:en since:2025-03-19 until:2025-03-20',
    ]


def test_collect_train_score(spark, capsys):
    pages, log, csv, model, out, state = (
        fresh_path(spark, n) for n in ("pages", "log", "csv", "model", "out", "state")
    )
    body = {"tweets": [{"id": "1", "text": "love it"}, {"id": "2", "text": "hate it"}], "has_next_page": False}
    spark.createDataFrame(
        [("gpt", "2025-03-18", "gpt-2", 1, True, json.dumps(body))],
        "keyword string, since string, topic string, page int, ok boolean, body string",
    ).write.parquet(pages)
    main(["collect", "--pages", pages, "--out", log])

    posts = [(4 if i % 2 else 0, str(i), "d", "q", "a", "love this" if i % 2 else "hate this") for i in range(80)]
    posts.append((None, "x", "d", "q", "a", "no label"))
    spark.createDataFrame(posts, LABELLED).write.csv(csv)
    main(["train", "--csv", csv, "--model", model, "--vocabulary", "50", "--features", "60", "--train-sample", "0.9"])

    main(["score", "--model", model, "--log", log, "--out", out, "--route", "gpt-2:gpt_out"])
    scored = {r.tweet_id: r for r in spark.read.parquet(out).collect()}
    assert {k: (r.sentiment_prediction, r.collection) for k, r in scored.items()} == {
        "1": ("1.0", "gpt_out"),
        "2": ("0.0", "gpt_out"),
    }
    batches = fresh_path(spark, "batches")
    for _ in range(2):
        main(["score", "--model", model, "--log", log, "--out", batches, "--batch", "b1"])
    assert spark.read.parquet(batches).count() == 2
    streamed = fresh_path(spark, "streamed")
    for _ in range(2):
        main(["score", "--model", model, "--log", log, "--out", streamed, "--checkpoint", state])
    assert spark.read.parquet(streamed).filter(F.col("collection") == "gpt_predictions_2").count() == 2
    each = fresh_path(spark, "each")
    place = f"{each}/{{collection}}"
    for _ in range(2):
        main(["score", "--model", model, "--log", log, "--out", place, "--each", "json", "--option", "compression=none"])
    assert spark.read.json(f"{each}/gpt_predictions_2").count() == 4
    writers.publish_log(readers.read_message_log(spark, log, "gpt-2"), log + "-twice")
    writers.publish_log(readers.read_message_log(spark, log, "gpt-2"), log + "-twice")
    once = fresh_path(spark, "once")
    main(["score", "--model", model, "--log", log + "-twice", "--out", once, "--dedupe", "--format", "orc"])
    assert spark.read.orc(once).count() == 2
    shown = capsys.readouterr().out
    assert "n_written" in shown and "CountVectorizerModel" in shown and "Negative (0)" in shown


def test_bad_arguments():
    with pytest.raises(SystemExit):
        main(["plan", "--out", "x", "--keyword", "no-topic"])
    with pytest.raises(SystemExit):
        main(["score", "--model", "m", "--out", "o"])
    with pytest.raises(SystemExit):
        main(["score", "--model", "m", "--out", "o", "--log", "l", "--each", "f", "--option", "novalue"])
