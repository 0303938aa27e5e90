"""The given tables in the shapes of the three jobs.

Posts come from ``documents``, labels from ``labels``, attempt logs from
``events``. The rules below also produce broken, empty and missing values, so
that the whole tables exercise those paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import INPUT_TASKS_CONF

# Sources whose posts are broken on purpose.
EMPTY_TEXT = "src3"
NULL_TEXT = "src5"
BROKEN_JSON = "src7"

FIRST_DAY = "2025-03-18"
DAYS = 15


def target() -> Column:
    """0 = negative, 4 = positive."""
    return F.col("quality") * 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame) -> DataFrame:
    """The rows, dealt to the tasks that ``spark.tidemark.inputTasks`` asks for.

    For benchmarks on tables of a single row group, which one task would read.
    Without the setting the scan stays as it is, whatever its size.
    """
    tasks = rows.sparkSession.conf.get(INPUT_TASKS_CONF, "")
    return rows.repartition(int(tasks)) if tasks else rows


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dealt(table(spark, sf_dir, "documents"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with a label, as the training table plus ``doc_id``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    rows = dealt(docs).join(labels, "doc_id")
    return rows.select(
        "doc_id",
        target().cast("int").alias("target"),
        F.col("doc_id").cast("string").alias("id"),
        F.lit(FIRST_DAY).alias("date"),
        F.col("lang").alias("query"),
        F.col("source").alias("author"),
        F.col("text").alias("tweet"),
    )


def created_day() -> Column:
    """A day within the search period for documents, which have no date."""
    return F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("n_chars") % DAYS).cast("int"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as posts, with a field the declared schema does not have."""
    docs = documents(spark, sf_dir)
    text = F.when(F.col("source") == EMPTY_TEXT, "").when(F.col("source") == NULL_TEXT, None)
    key = F.col("doc_id").cast("string")
    return docs.select(
        key.alias("id"),
        F.concat(F.lit("https://posts.example/"), key).alias("url"),
        text.otherwise(F.col("text")).alias("text"),
        "lang",
        F.date_format(created_day(), "yyyy-MM-dd").alias("createdAt"),
        F.struct(
            F.col("source").alias("id"),
            F.concat(F.lit("user_"), "source").alias("userName"),
            F.upper("source").alias("name"),
            (F.col("n_chars") > 1000).alias("isBlueVerified"),
        ).alias("author"),
        (F.col("n_chars") + 1).alias("retweetCount"),
        (F.col("n_chars") + 2).alias("replyCount"),
        (F.col("n_chars") + 3).alias("likeCount"),
        (F.col("n_chars") + 4).alias("quoteCount"),
        (F.col("n_chars") + 5).alias("bookmarkCount"),
        (F.col("n_chars") + 6).alias("viewCount"),
        (F.col("lang") == "en").alias("isReply"),
        F.concat(F.lit("c"), key).alias("conversationId"),
        F.lit("web").alias("client"),
        "source",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts as JSON messages, topic = language, some values truncated."""
    rows = posts(spark, sf_dir)
    body = F.to_json(F.struct(*[c for c in rows.columns if c != "source"]))
    value = F.when(F.col("source") == BROKEN_JSON, F.expr("left(body, 20)")).otherwise(F.col("body"))
    return rows.withColumn("body", body).select(
        F.col("id").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.col("lang").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("id").cast("bigint").alias("offset"),
        F.lit(f"{FIRST_DAY} 00:00:00").cast("timestamp").alias("timestamp"),
    )


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` per event type, day and hour."""
    events = table(spark, sf_dir, "events").select("event_type", "ts", "props")
    k = F.from_json("props", "k bigint").getField("k")
    return (
        events.select(
            F.col("event_type").alias("keyword"),
            F.to_date("ts").alias("since"),
            (F.hour("ts") + 1).cast("bigint").alias("page"),
            k.alias("k"),
        )
        .groupBy("keyword", "since", "page")
        .agg(F.count("*").alias("n_events"), F.count_if(F.col("k") < 90).alias("n"), F.max("k").alias("top"))
    )


def attempt_log(spark: SparkSession, sf_dir: str, least: int = 1) -> DataFrame:
    """An attempt log: one search per event type and day, one attempt per hour.

    An hour with fewer than ``least`` events is a failed attempt; its page holds
    the events with k < 90, and a k of 99 marks the last page.
    """
    seen = hourly(spark, sf_dir)
    slots = (
        seen.select("keyword", "since")
        .distinct()
        .select("keyword", "since", F.explode(F.expr("sequence(1L, 24L)")).alias("page"))
    )
    ok = F.coalesce("n_events", F.lit(0)) >= least
    return slots.join(seen, ["keyword", "since", "page"], "left").select(
        "keyword",
        "since",
        "page",
        ok.alias("ok"),
        F.when(ok, F.col("n")).otherwise(0).alias("n"),
        (ok & (F.col("top") < 99)).alias("has_next"),
    )
