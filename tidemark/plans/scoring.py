"""Batch scoring: messages of many topics to one collection per topic."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.funnel import Tally
from tidemark.operators.messages import dedupe_posts, is_object, parse_posts, route, routes, score_input, score_output, unseen
from tidemark.sources.writers import append_collections

Scorer = Callable[[DataFrame], DataFrame]


def score_messages(
    messages: DataFrame, scorer: PipelineModel | Scorer, table: DataFrame, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Scored rows of all topics with their collection, in one pass.

    Works on a batch and on a stream: every step is row-local except the join
    with the small route table, which comes first, so that messages of topics
    without a collection are not even parsed.
    """
    kept = ("collection", *keep)
    transform = scorer.transform if isinstance(scorer, PipelineModel) else scorer
    posts = parse_posts(route(messages, table), keep=kept)
    return score_output(transform(score_input(posts, keep=kept)), keep=kept)


def new_rows(scored: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Scored rows without copies of a post in a collection, and without posts stored before.

    ``stored`` has ``collection`` and ``tweet_id`` of what is there. A post may
    go to several collections.
    """
    key = F.when(F.col("tweet_id").isNotNull(), F.struct("collection", "tweet_id"))
    rows = dedupe_posts(scored.withColumn("_key", key), "_key")
    if stored is not None:
        rows = unseen(rows, stored.select(F.struct("collection", "tweet_id").alias("_key")), "_key")
    return rows.drop("_key")


def run(
    messages: DataFrame,
    scorer: PipelineModel | Scorer,
    table: DataFrame,
    path: str,
    fmt: str = "parquet",
    dedupe: bool = False,
    stored: DataFrame | None = None,
) -> None:
    """Score and append; no rows means nothing is written."""
    scored = score_messages(messages, scorer, table)
    append_collections(new_rows(scored, stored) if dedupe else scored, path, fmt)


def run_counted(
    spark: SparkSession,
    read: Callable[[SparkSession], DataFrame],
    scorer: PipelineModel | Scorer,
    pairs: Iterable[tuple[str, str]],
    topics: Sequence[str],
    write: Callable[[DataFrame], None],
) -> DataFrame:
    """Score and ``write`` in one job that counts itself: the report of :func:`funnel.funnel_counts`,
    and ``n_predicted``, without reading the messages or the written rows again.

    ``pairs`` are the routes. A topic of ``topics`` without any message is not
    reported. The job reads in a session of its own: in Spark 4.1 a session that
    has observed rows can no longer use models that still have the summary of
    their training.
    """
    tally, kept = Tally(topics), ("collection", "topic")
    session = spark.newSession()
    transform = scorer.transform if isinstance(scorer, PipelineModel) else scorer
    value = F.col("value").cast("string")
    text = F.from_json(value, "text string").getField("text")
    # Each observation counts what passes its place in the plan.
    rows = tally.watch(read(session), "n_raw")
    rows = tally.watch(rows, "n_malformed", ~is_object(value))
    rows = tally.watch(rows, "n_valid", F.coalesce(text.isNotNull() & (text != ""), F.lit(False)))
    posts = parse_posts(route(rows, routes(session, pairs)), keep=("collection",))
    scored = tally.watch(transform(score_input(posts, keep=kept)), "n_predicted", F.col("prediction").isNotNull())
    write(tally.watch(score_output(scored, keep=kept), "n_written").drop("topic"))
    return tally.report(spark)
