"""From raw message rows to scored, routed rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.schemas import CARRIED, CLEANED, POST, ROUTES
from tidemark.session import local_table


def decode(messages: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Key and value as UTF-8 strings, and the topic."""
    return messages.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value_str"),
        "topic",
        *keep,
    )


def parse_json(rows: DataFrame, column: str, schema, keep: Iterable[str] = ()) -> DataFrame:
    """Parse a JSON column by a declared schema and expand its fields.

    Permissive: a value that is no JSON object gives nulls, a field of the
    wrong type gives null in that field only, unknown fields are ignored.

    The one-element ``inline`` expands the struct like ``doc.*`` would, but later
    filters on the fields stay above it; pushed below, they would parse again.
    """
    return rows.select(*keep, F.inline(F.array(F.from_json(column, schema))))


def parse_posts(messages: DataFrame, keep: Iterable[str] = (), fields: Iterable[str] | None = None) -> DataFrame:
    """Key, topic and the fields of a post; ``fields`` names the wanted ones, others are not parsed."""
    wanted = POST if fields is None else StructType([POST[name] for name in fields])
    kept = ("key", "topic", *keep)
    return parse_json(decode(messages, keep), "value_str", wanted, kept)


def is_object(json: str | Column) -> Column:
    """Whether a text is one whole JSON object, of whatever fields."""
    return F.coalesce(F.json_object_keys(json).isNotNull(), F.lit(False))


def of_topic(posts: DataFrame, topic: str) -> DataFrame:
    return posts.filter(F.col("topic") == topic)


def has_text(column: str = "tweet") -> Column:
    """Neither null nor empty; text that cleaning will empty still passes."""
    return F.col(column).isNotNull() & (F.col(column) != "")


def score_input(posts: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Rename the text to ``tweet``, keep the carried columns, drop no-text rows."""
    wanted = posts.select(*keep, "id", F.col("text").alias("tweet"), *CARRIED)
    return wanted.filter(has_text("tweet"))


def score_output(scored: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """The stored row: cleaned text and the prediction as text, rest unchanged."""
    return scored.select(
        *keep,
        F.col("id").alias("tweet_id"),
        F.col(CLEANED).alias("processed_text"),
        F.col("prediction").cast("string").alias("sentiment_prediction"),
        *CARRIED,
    )


def flatten_author(rows: DataFrame) -> DataFrame:
    """Only the author's user name in place of the struct."""
    return rows.withColumn("author_username", F.col("author.userName")).drop("author")


def routes(spark: SparkSession, pairs: Iterable[tuple[str, str]] = ROUTES) -> DataFrame:
    return local_table(spark, pairs, ("topic", "collection"))


def route(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Add the collection of each topic; topics without one are not stored.

    An equi-join with a local table whose size Spark knows.
    """
    return rows.join(table, "topic")


def dedupe_posts(rows: DataFrame, key: str = "id") -> DataFrame:
    """One row per key, the first in the order of its other columns; rows without a key all stay.

    An aggregation, not a window: copies of one post combine on the map side,
    so a heavily repeated key never gathers in one task.
    """
    rest = [c for c in rows.columns if c != key]
    one = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
    return one.select(key, "_row.*").select(*rows.columns).unionByName(rows.filter(F.col(key).isNull()))


def unseen(rows: DataFrame, stored: DataFrame, key: str = "tweet_id") -> DataFrame:
    """Rows whose key is not stored yet, for a repeatable append; rows without a key pass.

    ``stored`` should be bounded by the caller, for example to the collections
    and batches that a repeated message can be in. Its copies need no removal:
    the join only asks whether a key is there.
    """
    return rows.join(stored.select(F.col(key).alias("_stored")), F.col(key) == F.col("_stored"), "left_anti")
