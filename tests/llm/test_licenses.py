from __future__ import annotations

import random
import re

from compare import connect, duck_rows, spark_rows
from tidemark.llm.license_rules import BASE, all_rules
from tidemark.llm.licenses import CONFIDENCE, OP12_SQL, detections, labelled, op12_licenses

COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
RULES = all_rules()


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(key, text):
    """Every rule on every text, every pair of matches compared."""
    words = words_of(text)
    padded = "".join(f" {w} " for w in words)
    starts = {}
    at = 0
    for i, w in enumerate(words):
        starts[at] = i
        at += len(w) + 2
    hits = []
    for rule in RULES:
        for m in re.finditer(rule.pattern, padded):
            first = starts[m.start()]
            hits.append((first, first + len(m.group().split()) - 1, rule))
    places = [i for _, p in BASE for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    base = {label for label, p in BASE for i in range(len(words)) if words[i : i + len(p.split())] == p.split()}

    def covers(c, h):
        rank = lambda x: (x[2].priority, x[1] - x[0], -x[2].number)
        return c[0] <= h[0] and c[1] >= h[1] and rank(c) > rank(h)

    left = [h for h in hits if not any(covers(c, h) for c in hits)]
    labels = base | {h[2].label for h in left}
    return (
        key,
        len(words),
        len(places),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(labels)),
        max((CONFIDENCE[h[2].priority] for h in left), default=0.0),
    )


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def expected(rows):
    return sorted((brute(k, t) for k, t in rows), key=str)


def scan(docs):
    return labelled(detections(docs))


def test_rules():
    assert len(RULES) > 300 and len({r.number for r in RULES}) == len(RULES)
    # A keyword is a word of every match, so that the gate loses none.
    for rule in RULES:
        for word in rule.keywords:
            assert re.search(rf"(?<![\w?|(]){word}(?![\w?])", rule.pattern) or word in rule.pattern, rule


def test_documents(spark, small_dir, small_docs):
    df = op12_licenses(spark, small_dir)
    assert got(df) == expected([(r.doc_id, r.text) for r in small_docs.collect()])
    assert spark_rows(df) == duck_rows(connect(small_dir), OP12_SQL)


def test_edge_rows(edge_docs, edge_rows):
    assert got(scan(edge_docs)) == expected([(k, t) for k, t, _ in edge_rows])


def test_known_notices(spark):
    told = {
        "Licensed under the Apache License, Version 2.0.": ("apache", {"apache", "apache-2.0"}),
        "This is under the GNU General Public License, version 3.": ("gpl", {"gpl", "gpl-3.0"}),
        "Licensed under CC BY-NC 4.0": ("cc-by", {"cc-by", "cc-by-nc-4.0"}),
        "Released under the MIT License.": ("mit", {"mit"}),
        "SPDX-License-Identifier: GPL-2.0-only": ("", {"gpl-2.0"}),
        "see https://creativecommons.org/licenses/by-nc-sa/3.0/": ("", {"cc-by-nc-sa-3.0"}),
        "Apache License 1.1": ("apache", {"apache", "apache-1.1"}),
        "a gnu in general, public licenses and mit licensees": ("", set()),
        "Redistribution and use in source and binary forms, with or without modification, are permitted": ("", {"bsd"}),
        "the lgplv2.1 it is": ("", {"lgpl-2.1"}),
    }
    rows = list(enumerate(told))
    out = got(scan(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert [(r[5], set(filter(None, r[6].split(",")))) for r in out] == list(told.values())
    assert out == expected(rows)


def test_random_texts_of_rule_words(spark):
    """Texts of little but the rules' own words: overlaps, nesting and repeats."""
    rng = random.Random(5)
    runs = [re.sub(r"[^a-z0-9 ]", "", p.replace("(?:", "")) for p in (r.pattern for r in RULES)]
    glue = ["license", "version", "2", "0", "1", "only", "or later", "gnu", "cc by", "mit license", "İ", "x" * 50]
    rows = [(i, " ".join(rng.choice(runs if rng.random() < 0.5 else glue) for _ in range(rng.randint(0, 30)))) for i in range(120)]
    assert got(scan(spark.createDataFrame(rows, "doc_id bigint, text string"))) == expected(rows)


def test_long_text_and_repeated_rows(spark):
    long = "mit license cc by " * 20_000
    rows = [(1, long), (1, long), (None, "cc by"), (2, None)]
    out = got(scan(spark.createDataFrame(rows, "doc_id bigint, text string")))
    whole = (1, 80_000, 40_000, 0, 79_998, "cc-by,mit", "cc-by,mit", 0.7)
    assert out == sorted([whole, whole, (None, 2, 1, 0, 0, "cc-by", "cc-by", 0.7), (2, 0, 0, None, None, "", "", 0.0)], key=str)


def test_empty_table(no_docs):
    df = scan(no_docs)
    assert df.columns == COLUMNS and df.collect() == []


def test_spans_are_kept(spark):
    docs = spark.createDataFrame([(1, "under the Apache License, Version 2.0, ok")], "doc_id bigint, text string")
    spans = {(r.first, r.last, r.label) for r in detections(docs).filter("stands").collect()}
    assert (2, 6, "apache-2.0") in spans


def test_no_python_in_the_plan(spark, small_dir):
    plan = op12_licenses(spark, small_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
