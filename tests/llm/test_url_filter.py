from __future__ import annotations

import pytest

from compare import connect, duck_rows, spark_rows
from tidemark.llm.url_filter import OP3_SQL, judge_urls, op3_url_filter


def judged(spark, urls, **how):
    rows = [(i, url, "x") for i, url in enumerate(urls)]
    df = judge_urls(spark.createDataFrame(rows, "page_id bigint, url string, host string"), **how)
    return {r.page_id: r for r in df.collect()}


def of_sql(tmp_path, spark, urls):
    rows = [(i, url) for i, url in enumerate(urls)]
    spark.createDataFrame(rows, "page_id bigint, url string").coalesce(1).write.parquet(f"{tmp_path}/in")
    con = connect(str(tmp_path))
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/in/*.parquet'")
    return duck_rows(con, OP3_SQL)


def test_pages(spark, small_dir):
    df = op3_url_filter(spark, small_dir)
    assert {"page_id", "host", "path", "rule", "verdict"} <= set(df.columns)
    assert spark_rows(df) == duck_rows(connect(small_dir), OP3_SQL)


@pytest.mark.parametrize("sections", [4, 19, 20, 21, 40])
def test_verdicts_do_not_depend_on_the_number_of_sections(spark, tmp_path, sections):
    """Two blocked sections among clean ones of the same shape: all others stay, however many."""
    names = ["es", "fr", *[f"s{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(sections - 2)]]
    urls = [f"http://x.net/{name}/{i}" for name in names for i in range(10)]
    rows = judged(spark, urls)
    for i, url in enumerate(urls):
        bad = url.split("/")[3] in ("es", "fr")
        assert rows[i].verdict == ("block" if bad else "allow"), url
        assert rows[i].rule == (f"net/{url.split('/')[3]}/" if bad else None)
    if sections in (4, 21):
        df = judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string"))
        assert spark_rows(df) == of_sql(tmp_path, spark, urls)


def test_templates_without_labels_are_allowed(spark):
    """All labels say block: pages that no label is near still pass."""
    urls = [f"http://x.net/es/{i}" for i in range(20)] + [f"http://y.org/a/{i}" for i in range(5)]
    rows = judged(spark, urls)
    assert {rows[i].verdict for i in range(20)} == {"block"} and {rows[i].verdict for i in range(20, 25)} == {"allow"}


def test_pages_near_blocked_ones_are_rejected(spark):
    """Under a template whose labelled pages are nearly all blocked, a page without a label is blocked too."""
    rules = [("block", "x.org", f"/p/{c}/") for c in "abcdefghijklmnopqrst"]
    urls = [f"http://x.org/p/{c}/v/{i}" for c in "abcdefghijklmnopqrst" for i in range(1)]
    urls += ["http://x.org/p/u/v/9", "http://x.org/q/w"]
    rows = judged(spark, urls, rules=rules, pull=60)
    assert rows[len(urls) - 2].rule is None and rows[len(urls) - 2].template == rows[0].template
    assert rows[len(urls) - 1].verdict == "allow"


def test_deep_paths(spark, tmp_path):
    """Branches behind many common segments are told apart, and one step takes over what is common."""
    deep = "/".join(f"d{i}e" for i in range(60))
    rules = [("block", "x.org", f"/{deep}/bad/")]
    urls = [f"http://x.org/{deep}/bad/{i}/w" for i in range(12)] + [f"http://x.org/{deep}/good/a{i}z" for i in range(12)]
    urls += ["http://y.org/" + "z/" * 5000]
    rows = judged(spark, urls, rules=rules)
    assert {rows[i].verdict for i in range(12)} == {"block"} and {rows[i].verdict for i in range(12, 25)} == {"allow"}
    assert rows[0].template != rows[12].template and rows[0].template.startswith("/d0e/d1e/")
    assert rows[24].template.count("/") == 5001


def test_paths_that_branch_without_end(spark):
    """Two long paths of which every segment differs: the steps are bounded, and both stay whole."""
    urls = ["http://y.org/" + "a/" * 300, "http://y.org/" + "b/" * 300, "http://x.net/es/1"]
    rows = judged(spark, urls, branchings=2)
    assert [rows[i].verdict for i in range(3)] == ["allow", "allow", "block"]
    assert rows[0].template.endswith("/a/a/") and rows[1].template.endswith("/b/b/")
    assert rows[0].template.count("/") == rows[1].template.count("/") == 301


def test_odd_urls(spark, tmp_path):
    urls = [
        None,
        "",
        "no scheme",
        "://",
        "http://",
        "HTTP://EXAMPLE.Com/EN/1?x=/es/#y",
        "http://a.example.com/en/",
        "http://www.example.com/en/",
        "http://example.com?q#f",
        "http://É.net/es/é",
        "http://x.net/es",
        "http://x.net//",
        "http://x.net/" + "long" * 20_000,
        "http://x.net/deadbeef01/12.html",
    ] * 2
    rows = judged(spark, urls)
    assert len(rows) == len(urls)
    assert (rows[0].host, rows[0].path, rows[0].rule, rows[0].verdict) == ("", "", None, "allow")
    assert (rows[5].host, rows[5].path, rows[5].rule) == ("example.com", "/EN/1", "com/")
    assert (rows[6].rule, rows[6].verdict) == ("example.com/en/", "block")
    assert (rows[7].rule, rows[7].verdict) == ("www.example.com/en/", "allow")
    df = judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string"))
    assert spark_rows(df) == of_sql(tmp_path, spark, urls)


def test_repeated_ids_null_ids_and_empty_table(spark):
    pages = spark.createDataFrame(
        [(1, "http://x.net/es/1"), (1, "http://x.net/es/1"), (1, "http://b.com/"), (None, "http://b.com/")], "page_id bigint, url string"
    )
    got = sorted((str(r.page_id), r.host, r.verdict) for r in judge_urls(pages).collect())
    assert got == [("1", "b.com", "allow"), ("1", "x.net", "block"), ("1", "x.net", "block"), ("None", "b.com", "allow")]
    assert judge_urls(pages.filter("false")).collect() == []


def test_no_python_in_the_plan(spark, small_dir):
    plan = op3_url_filter(spark, small_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
