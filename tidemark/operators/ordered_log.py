"""Quota and failure rules for attempt logs without attempt numbers.

A log's attempts are ordered by any columns, for example a request time. Places
are found by a prefix sum over ranges: the log is range-partitioned by search
and order, each range is summed by search, sums of the ranges before are carried
in, and rows add what lies before them in their range. So a search that holds
most of the log is dealt over many ranges like everything else, and streaks of
failures go on across the borders of ranges.

Attempts with equal order values are ordered by ``ties``, then by where they
stood in the log. A null order value comes first. A null ``ok`` counts as a
failure; a failure, and a null ``n``, bring no posts; a null ``has_next`` ends
the search.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.collect import SEARCH_KEYS
from tidemark.schemas import MAX_FAILURES, QUOTA
from tidemark.session import land

ROW = "_row"
# More ranges than this are made only where each has WIDE_ROWS rows or more.
MANY_RANGES, WIDE_ROWS = 512, 1_000_000


def with_rows(log: DataFrame) -> DataFrame:
    """The log landed with a number that tells its rows apart, in the order in which they stood."""
    return land(log.withColumn(ROW, F.monotonically_increasing_id()), "log-rows")


def range_count(rows: int, rows_per_range: int) -> int:
    """How many ranges a log is dealt to.

    Each range costs the driver a hundred sampled keys, the state of its task
    and a place in every map task's sizes, so ranges of few rows are made while
    they are few; a larger log has wider ranges, up to ``WIDE_ROWS`` rows.
    """
    wanted = -(-rows // rows_per_range)
    return max(1, min(wanted, max(MANY_RANGES, -(-rows // WIDE_ROWS))))


def place_attempts(
    rows: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = SEARCH_KEYS,
    ties: Sequence[str] = (),
    rows_per_range: int = 1_000_000,
) -> DataFrame:
    """``(keys…, _row, ok, n, has_next, page, before, streak)`` of every row of ``with_rows``.

    ``page`` is the place in the search, from 1; ``before`` the posts of earlier
    pages; ``streak`` the failures in a row up to this attempt. A range has
    about ``rows_per_range`` rows, more in a log that would need too many ranges
    (:func:`range_count`).
    """
    ok = F.coalesce("ok", F.lit(False))
    slim = rows.select(
        *keys,
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate([*order, *ties])],
        ROW,
        ok.alias("ok"),
        F.when(ok, F.coalesce("n", F.lit(0))).otherwise(0).cast("bigint").alias("n"),
        F.coalesce("has_next", F.lit(False)).alias("has_next"),
    )
    sort = [f"_o{i}" for i in range(len(order) + len(ties))] + [ROW]
    dealt = slim.repartitionByRange(range_count(rows.count(), rows_per_range), *keys, *sort).withColumn("_range", F.spark_partition_id())
    inside = Window.partitionBy("_range", *keys).orderBy(*sort)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = (
        dealt.withColumn("_at", F.row_number().over(inside).cast("bigint"))
        .withColumn("_sum", F.sum("n").over(upto) - F.col("n"))
        .withColumn("_last_ok", F.max(F.when(F.col("ok"), F.col("_at"))).over(upto))
        .drop(*sort[:-1])
    )
    local = land(local, "log-ranges")
    carried = land(carry_in(local, keys), "log-carried")
    joined = same_keys(local, carried, ("_range", *keys))
    page = F.col("_pages_before") + F.col("_at")
    last_ok = F.coalesce(F.col("_pages_before") + F.col("_last_ok"), F.col("_ok_before"))
    return joined.select(
        *keys,
        ROW,
        "ok",
        "n",
        "has_next",
        page.alias("page"),
        (F.col("_posts_before") + F.col("_sum")).alias("before"),
        (page - last_ok).alias("streak"),
    )


def carry_in(local: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What each search brings into each range: attempts, posts, and the place of its last success.

    One row per range and search; the windows see a search's ranges only, not
    its rows. The last success before a range is the one of the largest place.
    """
    held = local.groupBy("_range", *keys).agg(
        F.count("*").alias("_pages"), F.sum("n").alias("_posts"), F.max("_last_ok").alias("_ok_at")
    )
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    summed = held.withColumn("_pages_before", zero(F.sum("_pages").over(before))).withColumn(
        "_posts_before", zero(F.sum("_posts").over(before))
    )
    reached = F.max(F.col("_pages_before") + F.col("_ok_at")).over(before)
    return summed.select("_range", *keys, "_pages_before", "_posts_before", zero(reached).alias("_ok_before"))


def same_keys(rows: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys of which nulls are equal; the keys of ``rows`` stay."""
    named = other.select(*[F.col(c).alias(f"_k{i}") if c in keys else F.col(c) for i, c in enumerate(other.columns)])
    name = {c: f"_k{i}" for i, c in enumerate(other.columns)}
    on = F.lit(True)
    for key in keys:
        on &= F.col(key).eqNullSafe(F.col(name[key]))
    return rows.join(named, on, how).drop(*[name[k] for k in keys])


def ends_search(max_failures: int) -> Column:
    """An empty page, a last page, or the failure that completes a streak."""
    return (F.col("streak") >= max_failures) | (F.col("ok") & ((F.col("n") == 0) | ~F.col("has_next")))


def ordered_last_pages(
    placed: DataFrame, keys: Sequence[str] = SEARCH_KEYS, quota: int = QUOTA, max_failures: int = MAX_FAILURES
) -> DataFrame:
    """``(keys…, last_page, n_pages, n_posts)`` of the searches that keep a page, from placed attempts.

    Aggregations with map-side combine only: the first end of a search, then
    the pages up to it. ``placed`` should be landed.
    """
    stops = placed.filter(ends_search(max_failures)).groupBy(*keys).agg(F.min("page").alias("_stop"))
    reach = same_keys(placed, land(stops, "log-stops"), keys, "left")
    kept = reach.filter(F.col("ok") & (F.col("n") > 0) & (F.col("before") < quota)).filter(
        F.col("_stop").isNull() | (F.col("page") <= F.col("_stop"))
    )
    return kept.groupBy(*keys).agg(
        F.max("page").alias("last_page"), F.count("*").alias("n_pages"), F.sum("n").alias("n_posts")
    )


def accept_ordered(
    log: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = SEARCH_KEYS,
    ties: Sequence[str] = (),
    quota: int = QUOTA,
    max_failures: int = MAX_FAILURES,
    **how,
) -> DataFrame:
    """The log's rows, payload and place (``page``) included, that the quota keeps.

    Whole pages are kept until their posts reach the quota; an empty page, a
    last page or ``max_failures`` failures in a row end a search.
    """
    rows = with_rows(log)
    placed = land(place_attempts(rows, order, keys, ties, **how), "log-placed")
    limits = land(ordered_last_pages(placed, keys, quota, max_failures).select(*keys, "last_page"), "log-limits")
    kept = same_keys(placed, limits, keys).filter("ok AND n > 0 AND page <= last_page").select(ROW, "page")
    return rows.drop("page").join(land(kept, "log-kept"), ROW).drop(ROW)


def cut_ordered(
    log: DataFrame,
    order: Sequence[str],
    keys: Sequence[str] = SEARCH_KEYS,
    ties: Sequence[str] = (),
    max_failures: int = MAX_FAILURES,
    **how,
) -> DataFrame:
    """The log's rows with their place, up to the attempt that completes a search's first streak of failures."""
    rows = with_rows(log)
    placed = land(place_attempts(rows, order, keys, ties, **how), "log-placed")
    stops = placed.filter(F.col("streak") >= max_failures).groupBy(*keys).agg(F.min("page").alias("_stop"))
    kept = same_keys(placed, land(stops, "log-stops"), keys, "left")
    kept = kept.filter(F.col("_stop").isNull() | (F.col("page") <= F.col("_stop"))).select(ROW, "page")
    return rows.drop("page").join(land(kept, "log-kept"), ROW).drop(ROW)
