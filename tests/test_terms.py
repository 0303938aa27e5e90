"""Term statistics against ML, small fixtures and different partitionings."""

from __future__ import annotations

import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.feature import IDF, CountVectorizerModel
from pyspark.sql import functions as F

from tidemark.operators import grams, terms
from tidemark.schemas import WORDS
from tidemark.session import land

DOCS = [["a", "b", "b"], ["b", "c"], ["d", "a", "e"], [""]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(DOCS)), f"doc_id long, {WORDS} array<string>")


def test_idf_and_tfidf_fixture(spark, docs):
    vocab = land(terms.weighted_vocabulary(docs, 1, 100, 4, 2), "vocab")
    idf = {r.term: r.idf for r in vocab.collect()}
    assert idf["a"] == idf["b"] == pytest.approx(math.log(5 / 3))
    assert idf["c"] == idf["d"] == idf["e"] == idf[""] == 0.0
    weights = {(r.doc_id, r.term): r.tfidf for r in terms.tfidf(docs, vocab, 1).collect()}
    assert weights[0, "b"] == pytest.approx(2 * math.log(5 / 3))
    assert weights[0, "a"] == pytest.approx(math.log(5 / 3))
    assert weights[3, ""] == 0.0


@pytest.mark.parametrize("n", [1, 2, 3])
def test_counts_against_a_loop(spark, docs, n):
    expected = Counter()
    for i, words in enumerate(DOCS):
        for j in range(len(words) - n + 1):
            expected[i, " ".join(words[j : j + n])] += 1
    rows = terms.term_counts(docs, n).collect()
    assert {(r.doc_id, r.term): r.tf for r in rows} == dict(expected)
    assert len(rows) == len(expected)


def test_rows_with_one_id_are_separate_posts(spark):
    """A post is a row: copies under one id are counted apart."""
    rows = spark.createDataFrame([(1, ["a", "a"]), (1, ["a"])], f"doc_id long, {WORDS} array<string>")
    assert sorted(r.tf for r in terms.term_counts(rows, 1).collect()) == [1, 2]


def test_top_terms_do_not_depend_on_partitions(spark):
    words = terms.with_words(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    results = []
    for parts in (1, 4, 8):
        top = terms.vocabulary(words.repartition(parts), 2, 500)
        results.append(sorted(map(tuple, top.collect())))
    assert results[0] == results[1] == results[2]
    assert [r[2] for r in sorted(results[0], key=lambda r: r[2])] == list(range(500))


def test_native_equals_ml_vectors(spark):
    words = terms.with_words(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).select("doc_id", WORDS)
    vocab = land(terms.weighted_vocabulary(words, 1, 400, words.count(), 5), "vocab")
    ordered = [r.term for r in vocab.orderBy("idx").collect()]
    tf = CountVectorizerModel.from_vocabulary(ordered, inputCol=WORDS, outputCol="tf").transform(words)
    ml = IDF(minDocFreq=5, inputCol="tf", outputCol="tfidf").fit(tf).transform(tf)
    expected = {}
    for row in ml.select("doc_id", "tfidf").collect():
        for i, v in zip(row.tfidf.indices, row.tfidf.values):
            expected[row.doc_id, int(i)] = float(v)
    ours = {(r.doc_id, r.feature): r.tfidf for r in terms.tfidf(words, vocab, 1).collect()}
    assert ours.keys() == expected.keys()
    assert all(ours[k] == pytest.approx(expected[k], abs=1e-12) for k in ours)


def test_one_term_holding_most_occurrences(spark):
    rows = spark.range(300).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 200, F.array_repeat(F.lit("hot"), 50))
        .otherwise(F.array(F.concat(F.lit("t"), "id")))
        .alias(WORDS),
    )
    totals = {r.term: r.total for r in terms.corpus_totals(rows, 1).collect()}
    counts = {r.term: r.df for r in terms.doc_freq(rows, 1).collect()}
    assert (totals["hot"], counts["hot"]) == (10_000, 200) and len(totals) == len(counts) == 101


@pytest.mark.parametrize("size", [1, 5, 40, 3000, 10**6])
def test_top_terms_equal_a_full_sort(spark, size):
    """Few ties, many ties at the border, and more places than terms."""
    words = terms.with_words(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).select("doc_id", WORDS)
    totals = land(terms.corpus_totals(words, 1, 2), "totals")
    rows = sorted(totals.collect(), key=lambda r: (r.n, -r.total, r.term))
    expected = []
    for n in (1, 2):
        own = [r for r in rows if r.n == n][:size]
        expected += [(n, r.term, r.total, i) for i, r in enumerate(own)]
    assert sorted(map(tuple, terms.top_terms(totals, [1, 2], size).collect())) == sorted(expected)


def test_ties_are_cut_without_ordering_them_all(spark):
    totals = land(spark.range(5000).selectExpr("1 as n", "concat('t', lpad(id, 6, '0')) as term", "if(id < 10, 9, 1) as total"), "ties")
    passing = totals.filter(terms.top_of(totals, 50))
    assert 50 <= passing.count() <= 100
    assert [r.term for r in terms.top_terms(totals, [1], 50).orderBy("idx").collect()] == [f"t{i:06d}" for i in range(50)]


def test_text_is_cleaned_once(spark):
    """The vocabulary reads landed words: its plan holds no cleaning."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = land(terms.with_words(docs).select("doc_id", WORDS), "words")
    plan = terms.weighted_vocabulary(words, 3, 100, 200, 5)._jdf.queryExecution().toString()
    assert "[^a-z" not in plan


def test_sizes_of_terms(spark):
    rows = spark.createDataFrame([(1, ["a", "", "b"])], f"doc_id long, {WORDS} array<string>")
    found = terms.terms(rows, 1, 2, 3).select("term", terms.term_size("term").alias("n"))
    assert sorted(map(tuple, found.collect())) == sorted(
        [("a", 1), ("", 1), ("b", 1), ("a ", 2), (" b", 2), ("a  b", 3)]
    )


def test_linear_score_equals_dot_product(spark, docs):
    docs = land(docs, "docs")
    vocab = land(terms.weighted_vocabulary(docs, 2, 100, 4, 1), "vocab")
    weights = land(vocab.select("feature", (F.col("feature") * 0.01 - 0.3).alias("coefficient")), "weights")
    coef = {r.feature: r.coefficient for r in weights.collect()}
    expected = Counter()
    for r in terms.tfidf(docs, vocab, 2).collect():
        expected[r.doc_id] += r.tfidf * coef[r.feature]
    rows = terms.linear_score(docs, vocab, weights, 2, intercept=0.2).collect()
    assert len(rows) == docs.count()
    for r in rows:
        margin = expected[r.doc_id] + 0.2
        assert r.margin == pytest.approx(margin)
        assert r.probability == pytest.approx(1 / (1 + math.exp(-margin)))
        assert r.prediction == float(r.probability > 0.5)


def test_linear_score_keeps_every_post(spark):
    """Empty posts, posts of unknown words and two posts of one id all get a row."""
    rows = [(1, ["a", "b"]), (1, ["a", "b"]), (2, []), (3, ["unknown"]), (None, ["b"])]
    posts = land(spark.createDataFrame(rows, f"doc_id long, {WORDS} array<string>"), "posts")
    vocab = spark.createDataFrame([(1, "a", 0, 1.0), (1, "b", 1, 1.0)], "n int, term string, feature long, idf double")
    weights = spark.createDataFrame([(0, 2.0), (1, -0.5)], "feature long, coefficient double")
    got = [(r.doc_id, r.margin) for r in terms.linear_score(posts, vocab, weights, 1, intercept=0.1).collect()]
    assert sorted(got, key=str) == sorted([(1, 1.6), (1, 1.6), (2, 0.1), (3, 0.1), (None, -0.4)], key=str)


def test_counting_needs_no_shuffle(docs):
    plan = terms.term_counts(docs, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan




def test_linear_score_without_and_with_a_join(spark):
    """Equal margins by the constant table, which shuffles no post, and by the join."""
    texts = [(i, [f"w{(i * k) % 37}" for k in range(i % 23)] or None) for i in range(200)] + [(7, ["É", "w1"]), (None, ["w2"])]
    posts = land(spark.createDataFrame(texts, "doc_id int, words array<string>"), "posts")
    vocab = land(terms.weighted_vocabulary(posts.filter("words is not null"), 3, 500, 200, 1), "vocab")
    weights = land(vocab.select("feature", ((F.col("feature") % 11 - 5) / 7.0).alias("coefficient")), "weights")
    inside = terms.linear_score(posts, vocab, weights, 3, intercept=0.3)
    joined = terms.linear_score(posts, vocab, weights, 3, intercept=0.3, most_terms=0)
    rows = [sorted((str(r.doc_id), round(r.margin, 9), r.prediction) for r in df.collect()) for df in (inside, joined)]
    assert rows[0] == rows[1] and len(rows[0]) == len(texts)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (inside, joined)]
    assert "Exchange" not in plans[0] and "Exchange" in plans[1]


@pytest.mark.parametrize("size, tracked, buckets", [(5, 40, 1 << 16), (5, 10, 4), (20, 20, 64), (300, 600, 1 << 20), (10_000, 20_000, 16)])
def test_frequent_totals_hold_all_that_can_be_in_the_top(spark, size, tracked, buckets):
    """Exact totals, whatever the summaries miss and however many terms share a bucket."""
    rng = random.Random(size)
    texts = [(i, [f"w{int(rng.paretovariate(0.7)) % 4000}" for _ in range(rng.randint(0, 40))]) for i in range(400)]
    words = land(spark.createDataFrame(texts, "doc_id int, words array<string>").repartition(7), "words")
    whole = land(terms.corpus_totals(words, 1, 2), "totals")
    wanted = sorted(map(tuple, terms.top_terms(whole, [1, 2], size).collect()))
    found = land(terms.frequent_totals(words, [1, 2], size, tracked=tracked, buckets=buckets), "frequent")
    exact = {(r.n, r.term): r.total for r in whole.collect()}
    assert all(exact[r.n, r.term] == r.total for r in found.collect())
    assert sorted(map(tuple, terms.top_terms(found, [1, 2], size).collect())) == wanted
    if (size, tracked) == (5, 40):
        assert found.count() < whole.count() / 2


def test_direct_counts_and_summaries_give_the_same_top(spark):
    words = land(terms.with_words(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).select(WORDS), "words")
    both = [land(terms.rank_totals(words, [1, 2], 20, direct=d), "totals") for d in (10**9, 0)]
    tops = [sorted(map(tuple, terms.top_terms(t, [1, 2], 20).collect())) for t in both]
    assert tops[0] == tops[1] and len(tops[0]) == 40 and both[1].count() < both[0].count()


def test_frequent_totals_of_nothing(spark):
    none = land(spark.createDataFrame([(1, [])], "doc_id int, words array<string>"), "words")
    assert terms.frequent_totals(none, [1, 2], 5).collect() == []


def test_counts_inside_tasks_against_a_loop(spark):
    """Slices of a few words, null and empty lists, posts longer than a slice; n-grams stay within their post."""
    rng = random.Random(3)
    texts = [(i, None if i % 13 == 0 else [rng.choice(["a", "b", "", "ü"]) for _ in range(rng.choice([0, 1, 2, 5, 30]))]) for i in range(80)]
    posts = spark.createDataFrame(texts, "doc_id int, words array<string>").repartition(3)
    grams = lambda w, n: [" ".join(w[j : j + n]) for j in range(len(w or ()) - n + 1)]
    per_post = {(i, n, t): c for i, w in texts for n in (1, 3) for t, c in Counter(grams(w, n)).items()}
    for most in (1, 7, 10**6):
        rows = posts.mapInArrow(terms.post_counter([1, 3], "words", ["doc_id"], most), "doc_id int, term string, tf bigint")
        rows = rows.select("doc_id", terms.term_size("term"), "term", "tf").collect()
        assert {tuple(r)[:3]: r.tf for r in rows} == per_post and len(rows) == len(per_post)
        found = posts.select("words").mapInArrow(terms.slice_counter([1, 3], "words", most=most), "n int, term string, total bigint, df bigint")
        found = found.groupBy("n", "term").agg(F.sum("total").alias("total"), F.sum("df").alias("df")).collect()
        wanted = Counter(), Counter()
        for (_, n, t), c in per_post.items():
            wanted[0][n, t] += c
            wanted[1][n, t] += 1
        assert ({(r.n, r.term): r.total for r in found}, {(r.n, r.term): r.df for r in found}) == wanted
    assert "explode" not in terms.slice_totals(posts, 1, 3)._jdf.queryExecution().toString().lower()


def test_totals_of_buckets_and_sieved_counts_against_a_loop(spark):
    """Whatever the number of buckets; marked buckets lose no term; the vocabulary takes its document counts from the totals."""
    rng = random.Random(5)
    texts = [(i, None if i % 9 == 0 else [rng.choice(["a", "b", "", "ü", "cc"]) for _ in range(rng.choice([0, 1, 3, 20]))]) for i in range(60)]
    posts = land(spark.createDataFrame(texts, "doc_id int, words array<string>").repartition(3), "posts")
    grams = lambda w, n: [" ".join(w[j : j + n]) for j in range(len(w or ()) - n + 1)]
    totals = Counter((n, t) for _, w in texts for n in (1, 2, 3) for t in grams(w, n))
    df = Counter((n, t) for _, w in texts for n in (1, 2, 3) for t in set(grams(w, n)))
    for buckets in (1, 7, 1024):
        found = terms.all_totals(posts, 1, 2, 3, buckets=buckets).collect()
        assert {(r.n, r.term): (r.total, r.df) for r in found} == {k: (c, df[k]) for k, c in totals.items()}
        assert len(found) == len(totals)
    vocab = terms.weighted_vocabulary(posts, 3, 6, 60, 2)
    assert "MapInArrow" not in vocab._jdf.queryExecution().executedPlan().toString()
    vocab = land(vocab, "vocab")
    kept = {(r.n, r.term): (r.total, r.df) for r in vocab.collect()}
    assert len(kept) == 17 and all((totals[k], df[k]) == v for k, v in kept.items())
    expected = {(i, n, t): c for i, w in texts for n in (1, 2, 3) for t, c in Counter(grams(w, n)).items() if (n, t) in kept}
    rows = terms.known_terms(posts, vocab, 3).collect()
    assert {(r.doc_id, r.n, r.term): r.tf for r in rows} == expected and len(rows) == len(expected)
    sieved = terms.term_counts(posts, 1, 2, 3, wanted=terms.marked_terms(vocab.limit(1))).collect()
    assert {r.term for r in sieved} == {vocab.limit(1).first().term}


def test_known_terms_without_and_with_a_join(spark):
    """Equal rows looked up inside the tasks, which shuffles nothing, and by the join, whatever the slices."""
    rng = random.Random(11)
    texts = [(i % 50, None if i % 9 == 0 else [rng.choice(["a", "b", "", "ü", "cc"]) for _ in range(rng.choice([0, 1, 3, 20]))]) for i in range(60)]
    posts = land(spark.createDataFrame([*texts, (None, ["a", "b", "a"])], "doc_id int, words array<string>").repartition(3), "posts")
    held = land(terms.weighted_vocabulary(posts.filter("words is not null"), 3, 6, 60, 2), "vocab").select("n", "term", "feature", "idf")
    odd = spark.createDataFrame([(1, "nowhere", 90, 1.0), (4, "a b a b", 91, 1.0), (1, None, 92, 1.0)], held.schema)
    vocab = land(held.unionByName(odd), "vocab")
    ways = [terms.known_terms(posts, vocab, 3, columns=["feature", "term"], most=most) for most in (terms.MOST_MARKED, 0)]
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in ways]
    assert "Join" not in plans[0] and "Exchange" not in plans[0] and "Join" in plans[1]
    assert ways[0].columns == ways[1].columns == ["doc_id", "tf", "feature", "term"]
    rows = [sorted(map(str, df.collect())) for df in ways]
    assert rows[0] == rows[1] and len(rows[0]) > 100
    weights = [terms.tfidf(posts, vocab, 3), terms.tfidf(posts, vocab, 3, columns=["feature"])]
    assert all("Exchange" not in df._jdf.queryExecution().executedPlan().toString() for df in weights)
    assert weights[1].columns == ["doc_id", "feature", "tf", "tfidf"]
    same = [sorted(map(str, df.select("doc_id", "feature", "tf", "tfidf").collect())) for df in weights]
    assert same[0] == same[1] and len(same[0]) == len(rows[0])
    # A term of two rows counts for both, as in a join.
    assert terms.known_terms(posts, vocab.unionByName(vocab), 3).count() == 2 * len(rows[0])
    assert terms.known_terms(posts, vocab.limit(0), 3).count() == 0
    lists, table = posts.select("doc_id", "words").toArrow(), vocab.filter("term is not null").toArrow()
    shared, marks = (type("Shared", (), {"value": v}) for v in (table, grams.term_marks(table.column("term").to_pylist())))
    for most in (1, 7):
        count = grams.known_counter([1, 2, 3], "words", ["doc_id"], ["feature", "term"], shared, marks, most)
        found = [tuple(r.values()) for b in count(iter(lists.to_batches())) for r in b.to_pylist()]
        assert sorted(map(str, found)) == sorted(str(tuple(r)) for r in ways[0].collect())


def test_buckets_do_not_depend_on_blocks(monkeypatch):
    lists = pa.array([[f"w{i % 7}" for i in range(40)], ["a", None, "b"], []], pa.list_(pa.string()))

    def all_buckets():
        part = grams.Slice(lists)
        return {n: part.buckets(at, n, 1 << 10).tolist() for n, at in part.starts([1, 2, 3])}

    whole = all_buckets()
    monkeypatch.setattr(grams, "BLOCK", 7)
    assert all_buckets() == whole and len(whole[3]) == 38


def test_bucket_counts_make_no_table_for_each_slice():
    buckets = 1 << 20
    posts = pa.record_batch([pa.array([["a", "b", "a"]] * 50, pa.list_(pa.string()))], ["words"])
    tracemalloc.start()
    rows = list(grams.bucket_counter([1], "words", buckets, most=3)(iter([posts])))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    counts = [np.frombuffer(pa.decompress(x.as_buffer(), 4 * grams.PART, codec="zstd"), np.uint32) for x in rows[0].column("counts")]
    assert sorted(np.concatenate(counts)[np.concatenate(counts) > 0].tolist()) == [50, 100]
    assert peak < 1.6 * 8 * buckets
