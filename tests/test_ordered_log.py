"""Logs without attempt numbers: places, quota and cutoff against a plain loop."""

from __future__ import annotations

import random

import pytest

from tidemark.operators import collect, ordered_log

LOG = "keyword string, at int, tie int, ok boolean, n int, has_next boolean, body string"


def _rows(searches, rng):
    """searches: {key: [(at, ok, n, has_next), …]}; dealt in no order."""
    rows = [(k, at, i, ok, n, more, f"{k}{i}") for k, pages in searches.items() for i, (at, ok, n, more) in enumerate(pages)]
    rng.shuffle(rows)
    return rows


def _in_order(rows, key):
    own = [r for r in rows if r[0] == key]
    return sorted(own, key=lambda r: (r[1] is not None, r[1] or 0, r[2]))


def _loop(pages, quota, max_failures):
    """Bodies kept by the quota, request by request, and up to the cutoff."""
    kept, cut, total, failures, open_, cutting = [], [], 0, 0, True, True
    for _, _, _, ok, n, more, body in pages:
        n = n or 0
        failures = 0 if ok else failures + 1
        if cutting:
            cut.append(body)
            cutting = failures < max_failures
        if open_ and ok and n > 0 and total < quota:
            kept.append(body)
        if open_ and (failures >= max_failures or (ok and (n == 0 or not more))):
            open_ = False
        total += n if ok else 0
    return kept, cut


def _check(spark, rows, quota=20, max_failures=3, **how):
    log = spark.createDataFrame(rows, LOG).repartition(6)
    place = {"order": ["at"], "keys": ["keyword"], "ties": ["tie"], **how}
    kept = sorted(r.body for r in ordered_log.accept_ordered(log, **place, quota=quota, max_failures=max_failures).collect())
    cut = sorted(r.body for r in ordered_log.cut_ordered(log, **place, max_failures=max_failures).collect())
    wanted = [_loop(_in_order(rows, key), quota, max_failures) for key in {r[0] for r in rows}]
    assert kept == sorted(b for k, _ in wanted for b in k)
    assert cut == sorted(b for _, c in wanted for b in c)


def _random_search(rng, length):
    return [
        (rng.choice([None, *range(length)]), rng.choice([True, True, False, None]), rng.choice([None, 0, 1, 2, 5]), rng.choice([True] * 9 + [None]))
        for _ in range(length)
    ]


@pytest.mark.parametrize("rows_per_range", [3, 40, 1_000_000])
def test_random_searches(spark, rows_per_range):
    rng = random.Random(rows_per_range)
    searches = {k: _random_search(rng, rng.randint(1, 30)) for k in ["a", "b", "c", None, ""]}
    _check(spark, _rows(searches, rng), rows_per_range=rows_per_range)


def test_hot_search_and_streaks_over_borders(spark):
    """One search holds nearly all rows; its only streak of failures lies over many ranges of two rows."""
    rng = random.Random(2)
    hot = [(i, i % 3 != 0, 1, True) for i in range(90)] + [(90 + i, False, 0, True) for i in range(7)] + [(200, True, 4, True)]
    rows = _rows({"hot": hot, "cold": [(1, True, 3, False), (2, True, 3, True)]}, rng)
    _check(spark, rows, quota=1000, max_failures=7, rows_per_range=2)
    placed = ordered_log.place_attempts(
        ordered_log.with_rows(spark.createDataFrame(rows, LOG)), ["at"], ["keyword"], ["tie"], rows_per_range=2
    )
    hot_rows = sorted((r.page, r.streak) for r in placed.filter("keyword = 'hot'").collect())
    assert [p for p, _ in hot_rows] == list(range(1, 99)) and [s for _, s in hot_rows][89:] == [0, *range(1, 8), 0]


def test_copies_count_each(spark):
    rows = [("a", 1, 1, True, 4, True, "same")] * 10
    log = spark.createDataFrame(rows, LOG)
    kept = ordered_log.accept_ordered(log, ["at"], ["keyword"], quota=10, rows_per_range=3)
    assert sorted(r.page for r in kept.collect()) == [1, 2, 3]


def test_same_as_numbered_logs(spark):
    rng = random.Random(9)
    rows = [
        (key, "d", i + 1, rng.random() < 0.7, rng.randint(0, 6), rng.random() < 0.97)
        for key in "abcdef"
        for i in range(rng.randint(1, 40))
    ]
    log = spark.createDataFrame(
        [(k, s, p, ok, n if ok else 0, more) for k, s, p, ok, n, more in rows],
        "keyword string, since string, page int, ok boolean, n int, has_next boolean",
    )
    own = ordered_log.accept_ordered(log.withColumnRenamed("page", "number"), ["number"], quota=25, rows_per_range=7)
    old = collect.accept_pages(log, quota=25)
    assert sorted((r.keyword, r.page, r.n) for r in own.collect()) == sorted((r.keyword, r.page, r.n) for r in old.collect())


def test_empty_log(spark):
    log = spark.createDataFrame([], LOG)
    assert ordered_log.accept_ordered(log, ["at"], ["keyword"]).collect() == []
    assert ordered_log.cut_ordered(log, ["at"], ["keyword"]).collect() == []


def test_ranges_are_few_until_they_are_wide(spark):
    assert [ordered_log.range_count(n, 500) for n in (0, 1, 500, 501, 100_000)] == [1, 1, 1, 2, 200]
    assert ordered_log.range_count(6_000_000, 500) == ordered_log.range_count(36_000_000, 500) == ordered_log.MANY_RANGES
    assert ordered_log.range_count(10**10, 500) == 10_000
    log = spark.range(3000).selectExpr("'a' as keyword", "id as at", "id as tie", "true as ok", "1 as n", "true as has_next")
    placed = ordered_log.place_attempts(ordered_log.with_rows(log), ["at"], ["keyword"], ["tie"], rows_per_range=2)
    plan = ordered_log.with_rows(placed.select("page", "before"))
    assert plan.filter("page = before + 1").count() == plan.select("page").distinct().count() == 3000
    largest = placed.select("page").inputFiles()
    assert len({f for f in largest if "log-ranges" in f}) <= ordered_log.MANY_RANGES
