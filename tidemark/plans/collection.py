"""Collection: landed API responses to messages, under a quota per search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.collect import SEARCH_KEYS, accept_pages, page_attempts, publish_counts, to_messages
from tidemark.session import land


def collect_posts(pages: DataFrame, keys: Sequence[str] = SEARCH_KEYS, **limits) -> DataFrame:
    """Posts of the accepted pages, one row each, with search keys and topic.

    ``pages`` has the keys, ``topic``, ``page``, ``ok``, ``tweets``,
    ``has_next_page`` and ``next_cursor``. The attempts are landed, so that
    bodies are parsed once, and the posts as well: counts and messages are of
    the same posts.
    """
    attempts = land(page_attempts(pages), "attempts")
    accepted = accept_pages(attempts, keys, **limits)
    return land(accepted.select(*keys, "topic", "page", F.explode_outer("tweets").alias("post")), "accepted-posts")


def run(pages: DataFrame, keys: Sequence[str] = SEARCH_KEYS, **limits) -> tuple[DataFrame, DataFrame]:
    """The messages to publish and the counts per search and in total."""
    posts = collect_posts(pages, keys, **limits)
    records = posts.select("topic", "post.*")
    body = [c for c in records.columns if c != "topic"]
    return to_messages(records, "topic", body), publish_counts(posts, keys)
