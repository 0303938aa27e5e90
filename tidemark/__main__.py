"""The jobs from the command line: ``spark-submit -m`` style entry points.

python -m tidemark plan    --out PLAN [--start DAY --end DAY --keyword word:topic …]
python -m tidemark collect --pages LANDED --out LOG | --kafka SERVERS [--quota 800]
python -m tidemark train   --csv POSTS --model MODEL [--train-sample 0.5 --test-sample 0.5] [--full]
python -m tidemark score   --model MODEL --log LOG | --kafka SERVERS --out COLLECTIONS
                           [--route topic:collection …] [--batch ID | --checkpoint STATE [--within "1 hour"]]
                           [--format parquet] [--dedupe] [--each FORMAT --option key=value …]

``--each`` appends to a store that takes one collection per write; the
collection's name goes into the option ``collection``, and ``--out`` is its
path or address.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import schemas
from tidemark.operators.collect import configured_plan
from tidemark.operators.funnel import funnel_counts
from tidemark.operators.labels import split_usable
from tidemark.operators.messages import routes
from tidemark.operators.split import (
    TEST_SAMPLE_SEED,
    TRAIN_SAMPLE_SEED,
    hash_sample,
    hash_split,
    split_counts,
    with_split,
)
from tidemark.plans import collection, scoring, training
from tidemark.session import build_session, cleanup, land
from tidemark.sources import readers, writers
from tidemark.streaming import scoring as stream


def _pair(text: str) -> tuple[str, str]:
    left, _, right = text.rpartition(":")
    if not left:
        raise argparse.ArgumentTypeError(f"expected name:target, got {text!r}")
    return left, right


def plan(spark: SparkSession, args) -> None:
    keywords = args.keyword or schemas.KEYWORDS
    table = configured_plan(spark, keywords, args.start, args.end, args.lang)
    table.write.mode("overwrite").parquet(args.out)


def read_landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed responses: ``keyword, since, topic, page, ok, body`` (JSON)."""
    raw = spark.read.schema(
        "keyword string, since string, topic string, page int, ok boolean, body string"
    ).parquet(path)
    parsed = raw.withColumn("_p", F.from_json("body", schemas.API_PAGE))
    return parsed.select("keyword", "since", "topic", "page", "ok", "_p.*")


def collect(spark: SparkSession, args) -> None:
    sent, counts = collection.run(read_landed_pages(spark, args.pages), quota=args.quota)
    if args.kafka:
        writers.publish_kafka(sent, args.kafka)
    else:
        writers.publish_log(sent, args.out)
    counts.orderBy("since", "keyword").show(truncate=False)


def train(spark: SparkSession, args) -> None:
    """Rows are split by their id: the same rows train on every run."""
    posts = readers.read_labelled_csv(spark, args.csv)
    usable, unusable = split_usable(posts, "tweet", "target")
    learn, held_out = hash_split(usable, "id")
    learn = hash_sample(learn, "id", args.train_sample, TRAIN_SAMPLE_SEED)
    held_out = hash_sample(held_out, "id", args.test_sample, TEST_SAMPLE_SEED)
    used = learn.select("id").unionByName(held_out.select("id"))
    split_counts(with_split(used, "id")).show()
    spec = training.Spec(vocab_size=args.vocabulary, top_features=args.features, full=args.full)
    selection = training.select_features(learn, spec)
    model = training.fit_selected(learn, selection, spec)
    writers.save_model(model, args.model)
    training.describe_stages(spark, model.stages).orderBy("position").show(truncate=False)
    training.describe_fitted_labels(spark, selection.labels).show()
    metrics, matrix = training.evaluate(model, held_out)
    metrics.show()
    matrix.show()
    unusable.agg(F.count("*").alias("rows_without_text_or_label")).show()


def _key_value(text: str) -> tuple[str, str]:
    key, _, value = text.partition("=")
    if not key or not value:
        raise argparse.ArgumentTypeError(f"expected key=value, got {text!r}")
    return key, value


def score(spark: SparkSession, args) -> None:
    pairs = args.route or schemas.ROUTES
    topics = [topic for topic, _ in pairs]
    table = routes(spark, pairs)
    model = writers.load_model(args.model)
    if args.checkpoint:
        source = stream.kafka_stream(spark, args.kafka, topics) if args.kafka else stream.log_stream(spark, args.log)
        how = {"within": args.within, "post_time": args.post_time}
        if args.each:
            if "{collection}" not in args.out:
                raise SystemExit("a stream into a store per collection writes folders: --out must name {collection}")
            options = dict(args.option or ())

            def save_batch(writer, name: str, batch: int) -> None:
                target = f"{args.out.format(collection=name)}/batch={batch}"
                writer.format(args.each).options(**options).mode("overwrite").save(target)

            names = [name for _, name in pairs]
            stream.start_each(source, model, table, names, save_batch, args.checkpoint, **how).awaitTermination()
        else:
            stream.start(source, model, table, args.out, args.checkpoint, args.format, **how).awaitTermination()
        return
    if args.kafka:
        messages = readers.read_kafka(spark, args.kafka, topics)
    else:
        messages = readers.read_message_log(spark, args.log, topics)
    scored = scoring.score_messages(messages, model, table)
    # Landed: the rows that are written are the rows that are counted.
    scored = land(scoring.new_rows(scored, None) if args.dedupe else scored, "scored")
    if args.each:
        options = dict(args.option or ())

        def save(writer, name: str) -> None:
            writer.format(args.each).options(**options).option("collection", name).save(args.out.format(collection=name))

        writers.append_each(scored, [name for _, name in pairs], save)
    elif args.batch:
        writers.write_batch(scored, args.out, args.batch, args.format)
    else:
        writers.append_collections(scored, args.out, args.format)
    stored = scored.select("collection").join(table, "collection").select("topic")
    funnel_counts(messages, stored).orderBy("is_total", "topic").show(truncate=False)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidemark")
    jobs = top.add_subparsers(required=True)

    p = jobs.add_parser("plan")
    p.add_argument("--out", required=True)
    p.add_argument("--start", default=schemas.SEARCH_START)
    p.add_argument("--end", default=schemas.SEARCH_END)
    p.add_argument("--lang", default=schemas.SEARCH_LANG)
    p.add_argument("--keyword", type=_pair, action="append")
    p.set_defaults(job=plan)

    p = jobs.add_parser("collect")
    p.add_argument("--pages", required=True)
    p.add_argument("--quota", type=int, default=schemas.QUOTA)
    target = p.add_mutually_exclusive_group(required=True)
    target.add_argument("--out")
    target.add_argument("--kafka")
    p.set_defaults(job=collect)

    p = jobs.add_parser("train")
    p.add_argument("--csv", required=True)
    p.add_argument("--model", required=True)
    p.add_argument("--vocabulary", type=int, default=training.Spec.vocab_size)
    p.add_argument("--features", type=int, default=training.Spec.top_features)
    p.add_argument("--train-sample", type=float, default=1.0)
    p.add_argument("--test-sample", type=float, default=1.0)
    p.add_argument("--full", action="store_true")
    p.set_defaults(job=train)

    p = jobs.add_parser("score")
    p.add_argument("--model", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--route", type=_pair, action="append")
    source = p.add_mutually_exclusive_group(required=True)
    source.add_argument("--log")
    source.add_argument("--kafka")
    mode = p.add_mutually_exclusive_group()
    mode.add_argument("--batch")
    mode.add_argument("--checkpoint")
    p.add_argument("--each")
    p.add_argument("--option", type=_key_value, action="append")
    p.add_argument("--format", default="parquet")
    p.add_argument("--within")
    p.add_argument("--post-time", action="store_true")
    p.add_argument("--dedupe", action="store_true")
    p.set_defaults(job=score)
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    own = SparkSession.getActiveSession() is None
    spark = build_session()
    try:
        args.job(spark, args)
    finally:
        if own:
            cleanup(spark)


if __name__ == "__main__":
    main()
