"""Cleaning, tokens and n-grams: edge strings, ML stages, a plain-Python model."""

from __future__ import annotations

import re

import pytest
from pyspark.ml.feature import NGram, SQLTransformer, Tokenizer
from pyspark.sql import functions as F

from tidemark.functions.text import clean_sql, clean_text, ngrams, strip_urls, tokenize
from tidemark.operators.terms import with_words
from tidemark.schemas import CLEANED, WORDS

# input, cleaned, tokens, 2-grams
EDGES = [
    ("Hello  World", "hello  world", ["hello", "", "world"], ["hello ", " world"]),
    ("  lead trail  ", "lead trail", ["lead", "trail"], ["lead trail"]),
    ("", "", [""], []),
    ("   ", "", [""], []),
    (
        "don't STOP! http://a.b/c?d now",
        "dont stop  now",
        ["dont", "stop", "", "now"],
        ["dont stop", "stop ", " now"],
    ),
    ("a\tb", "ab", ["ab"], []),
    ("a\nb", "a\nb", ["a", "b"], ["a b"]),
    ("\n x", "\n x", ["", "", "x"], [" ", " x"]),
    ("éclair ré", "clair r", ["clair", "r"], ["clair r"]),
    ("123 456", " ", [], []),
    ("see xhttp://q www.z.com.", "see x ", ["see", "x"], ["see x"]),
    ("@ hi", " hi", ["", "hi"], [" hi"]),
    ("a b ", "a b", ["a", "b"], ["a b"]),
    ("wwwx www.", "wwwx www", ["wwwx", "www"], ["wwwx www"]),
    ("http", "http", ["http"], []),
    ("a\rb", "ab", ["ab"], []),
    ("a b", "ab", ["ab"], []),
    ("x\n\n", "x\n\n", ["x"], []),
]


def _frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def _grams(df):
    return df.select("doc_id", CLEANED, WORDS, *[ngrams(WORDS, n).alias(f"g{n}") for n in (1, 2, 3)])


def test_edge_strings(spark):
    rows = _grams(with_words(_frame(spark, [e[0] for e in EDGES]))).orderBy("doc_id").collect()
    for row, (text, cleaned, tokens, pairs) in zip(rows, EDGES):
        assert row[CLEANED] == cleaned, text
        assert row[WORDS] == tokens, text
        assert row.g1 == tokens and row.g2 == pairs, text


def test_trigrams(spark):
    texts = ["Hello  World", "don't STOP! http://a.b/c?d now", "\n x", "a b"]
    rows = _grams(with_words(_frame(spark, texts))).orderBy("doc_id").collect()
    assert [r.g3 for r in rows] == [["hello  world"], ["dont stop ", "stop  now"], ["  x"], []]


def test_null_text_stays_null(spark):
    row = _grams(with_words(spark.createDataFrame([(1, None)], "doc_id long, text string"))).first()
    assert row[CLEANED] is None and row[WORDS] is None


def test_equal_to_ml_stages(spark):
    extra = ["one\x0btwo", "tab\tand\fform feed\r\n", "HTTP://UP.case x", "www.a www.b  end ", "ß İ K ſ"]
    df = _frame(spark, [e[0] for e in EDGES] + extra)
    ml = SQLTransformer(statement=f"SELECT *, {clean_sql('text')} AS ml_clean FROM __THIS__").transform(df)
    ml = Tokenizer(inputCol="ml_clean", outputCol="ml_words").transform(ml)
    for n in (1, 2, 3):
        ml = NGram(n=n, inputCol="ml_words", outputCol=f"m{n}").transform(ml)
    both = with_words(ml)
    both = both.select("*", *[ngrams(WORDS, n).alias(f"g{n}") for n in (1, 2, 3)])
    for row in both.collect():
        assert row[CLEANED] == row.ml_clean
        assert row[WORDS] == row.ml_words
        assert [row.g1, row.g2, row.g3] == [row.m1, row.m2, row.m3]


def test_tokenize_of_raw_text_equals_tokenizer(spark):
    texts = ["A\tb\x0bC\fd\re\nf ", " \t\n", "", "no-space", "x  \t y\n"]
    df = Tokenizer(inputCol="text", outputCol="ml").transform(_frame(spark, texts))
    for row in df.select("ml", tokenize("text").alias("ours")).collect():
        assert row.ours == row.ml


def _plain_clean(text: str) -> str:
    text = re.sub(r"http\S+|www\.\S+", "", text.strip(" ").lower(), flags=re.ASCII)
    return re.sub(r"[^a-zA-Z\n ]", "", text)


def test_whole_documents_against_plain_python(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for row in _grams(with_words(df)).join(df, "doc_id").collect():
        cleaned = _plain_clean(row.text)
        words = re.split(r"[ \n]", cleaned.rstrip(" \n"))
        assert row[CLEANED] == cleaned and row[WORDS] == words
        for n in (2, 3):
            assert row[f"g{n}"] == [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]


def test_single_steps(spark):
    df = _frame(spark, ["Keep THIS 1 http://x y"])
    assert df.select(strip_urls("text").alias("u")).first().u == "Keep THIS 1  y"


@pytest.mark.parametrize("n", [1, 2, 3])
def test_cleaning_runs_once_per_row(spark, n):
    """No pushed-down filter or lambda repeats the cleaning expression."""
    from tidemark.operators.terms import term_counts, terms

    words = with_words(_frame(spark, ["a b c"]))
    for df in (terms(words, n), term_counts(words, n)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("[^a-z") == 1


def test_clean_text_is_one_projection(spark):
    df = _frame(spark, ["a"]).select(clean_text("text").alias("c"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert df.select(F.length("c")).first()[0] == 1
