"""Declared schemas and fixed settings of the three jobs."""

from __future__ import annotations

from pyspark.sql import types as T

LABELLED = T.StructType(
    [
        T.StructField("target", T.IntegerType()),
        T.StructField("id", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("query", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("tweet", T.StringType()),
    ]
)

# The author inside a post.
AUTHOR = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("userName", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("isBlueVerified", T.BooleanType()),
    ]
)

# Field names and types of a post on the wire.
POST = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("createdAt", T.StringType()),
        T.StructField("author", AUTHOR),
        T.StructField("retweetCount", T.LongType()),
        T.StructField("replyCount", T.LongType()),
        T.StructField("likeCount", T.LongType()),
        T.StructField("quoteCount", T.LongType()),
        T.StructField("bookmarkCount", T.LongType()),
        T.StructField("viewCount", T.LongType()),
        T.StructField("isReply", T.BooleanType()),
        T.StructField("conversationId", T.StringType()),
    ]
)

# The message columns every reader yields, in the shape of a Kafka source row.
MESSAGE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

API_PAGE = T.StructType(
    [
        T.StructField("tweets", T.ArrayType(POST)),
        T.StructField("has_next_page", T.BooleanType()),
        T.StructField("next_cursor", T.StringType()),
    ]
)

# Post columns kept next to the prediction, in output order.
CARRIED = (
    "createdAt",
    "author",
    "likeCount",
    "quoteCount",
    "replyCount",
    "retweetCount",
    "viewCount",
    "conversationId",
    "url",
)

# Columns of the text steps; only processed_text is in the stored rows.
CLEANED = "letters"
WORDS = "words"

# Default routes (topic, collection) and searches (keyword, topic).
ROUTES = (
    ("gpt-2", "gpt_predictions_2"),
    ("copilot-2", "copilot_predictions_2"),
    ("gemini-2", "gemini_predictions_2"),
)
KEYWORDS = (
    ("gpt", "gpt-2"),
    ("copilot", "copilot-2"),
    ("gemini", "gemini-2"),
)
SEARCH_START = "2025-03-18"
SEARCH_END = "2025-04-01"
SEARCH_LANG = "en"
QUOTA = 800
MAX_FAILURES = 3
