"""Term statistics and TF-IDF in long form.

Corpus-wide statistics count the n-grams of all sizes in one pass, slice by
slice inside the tasks (``grams``), and combine on the map side, so frequent
terms cost no more than others. Counts per post need no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.functions.text import clean_text, ngrams, tokenize
from tidemark.operators.grams import (
    BUCKETS,
    PACKED,
    bucket_adder,
    bucket_counter,
    bucket_levels,
    bucket_marker,
    known_counter,
    margin_counter,
    packer,
    post_counter,
    slice_counter,
    term_marks,
    unpacked_totals,
)
from tidemark.schemas import CLEANED, WORDS
from tidemark.session import land

TOTALS = "n int, term string, total bigint, df bigint"


def with_words(posts: DataFrame, text: str = "text") -> DataFrame:
    """Add the cleaned text and its tokens."""
    return posts.withColumn(CLEANED, clean_text(text)).withColumn(WORDS, tokenize(CLEANED))


def _grams(sizes: Sequence[int]) -> Column:
    """The n-grams of all sizes of a post in one array."""
    parts = [ngrams(WORDS, n) for n in sizes]
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def term_size(term: str) -> Column:
    """The n of an n-gram: words hold no space, so it is one more than its spaces."""
    return F.length(term) - F.length(F.replace(F.col(term), F.lit(" "), F.lit(""))) + 1


def terms(posts: DataFrame, *sizes: int, keep: Sequence[str] = ()) -> DataFrame:
    """One row per n-gram occurrence.

    ``explode_outer`` and a filter on its output, because for a plain
    ``explode`` of a column Catalyst infers ``size(words) > 0`` and pushes it to
    the scan, where it runs the whole cleaning expression several times more.
    """
    grams = posts.select(*keep, F.explode_outer(_grams(sizes)).alias("term"))
    return grams.filter(F.col("term").isNotNull())


def term_counts(
    posts: DataFrame, *sizes: int, keep: Sequence[str] = ("doc_id",), wanted: Broadcast | None = None
) -> DataFrame:
    """One row per post and distinct n-gram, or each of the ``wanted`` buckets, with its count ``tf``.

    Counted inside the tasks, slice by slice. No shuffle.
    """
    rows = posts.select(*keep, WORDS)
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1]], "term string, tf bigint"])
    return rows.mapInArrow(post_counter(sizes, WORDS, list(keep), wanted=wanted), schema)


# As many terms are looked for inside the tasks at most; more of them are joined.
MOST_MARKED = 1 << 17


def marked_terms(vocab: DataFrame) -> Broadcast | None:
    """The buckets of the terms of ``vocab`` for tasks to sieve n-grams with; None where they are too many."""
    held = [r.term for r in vocab.select("term").limit(MOST_MARKED + 1).collect()]
    if len(held) > MOST_MARKED:
        return None
    return vocab.sparkSession.sparkContext.broadcast(term_marks([t for t in held if t is not None]))


def slice_totals(posts: DataFrame, *sizes: int, wanted: Broadcast | None = None) -> DataFrame:
    """``(n, term, total, df)``: counts of every n-gram, or each of the ``wanted`` buckets, within slices of posts."""
    return posts.select(WORDS).mapInArrow(slice_counter(sizes, WORDS, wanted=wanted), TOTALS)


def all_totals(posts: DataFrame, *sizes: int, buckets: int = 512) -> DataFrame:
    """``(n, term, total, df)`` of every n-gram, all sizes in one pass.

    n-grams travel as the bytes of their bucket and are added up bucket by
    bucket, so a task holds one part in ``buckets`` of the n-grams.
    """
    packed = posts.select(WORDS).mapInArrow(packer(sizes, WORDS, buckets), PACKED)
    return packed.groupBy("bucket").applyInArrow(unpacked_totals, TOTALS)


def corpus_totals(posts: DataFrame, *sizes: int) -> DataFrame:
    """``(n, term, total)``: corpus count of every n-gram, all sizes in one pass."""
    return all_totals(posts, *sizes).select("n", "term", "total")


def doc_freq(posts: DataFrame, *sizes: int) -> DataFrame:
    """``(term, df)``: number of posts that hold each n-gram."""
    return all_totals(posts, *sizes).select("term", "df")


def added_up(posts: DataFrame, sizes: Sequence[int], wanted: Broadcast) -> DataFrame:
    """``(n, term, total, df)`` of the n-grams of the ``wanted`` buckets."""
    sums = [F.sum(c).alias(c) for c in ("total", "df")]
    return slice_totals(posts, *sizes, wanted=wanted).groupBy("n", "term").agg(*sums)


def marked_buckets(counts: DataFrame, least: dict[int, int], below: dict[int, int]) -> Broadcast | None:
    """The buckets that count ``least`` of their n and not as much as ``below``; None if there is none."""
    rows = counts.mapInArrow(bucket_marker(least, below), "n int, part int, bits binary, marked bigint").collect()
    found = {r.n for r in rows if r.marked}
    marks = {n: b"".join(bytes(r.bits) for r in sorted(rows, key=lambda r: r.part) if r.n == n) for n in found}
    return counts.sparkSession.sparkContext.broadcast(marks) if marks else None


def frequent_totals(
    posts: DataFrame, sizes: Sequence[int], size: int, tracked: int | None = None, buckets: int = 1 << 22
) -> DataFrame:
    """``(n, term, total, df)`` of all terms that may be among the ``size`` most frequent of their n, ties included.

    No table of all n-grams: one pass counts them by bucket of their hash, the
    next counts the terms of the ``tracked`` fullest buckets of each n. The
    ``size``-th total of these is one that the result must reach, so of the
    other buckets only those that reach it are counted term by term. The totals
    are exact. Where the fullest buckets hold fewer terms than ``size`` all are
    counted. The driver gets one bit for each bucket.
    """
    buckets = -(-buckets // 8) * 8
    counted = posts.select(WORDS).mapInArrow(bucket_counter(sizes, WORDS, buckets), BUCKETS)
    counts = land(counted.groupBy("n", "part").applyInArrow(bucket_adder(buckets), BUCKETS), "bucket-counts")
    levels = counts.mapInArrow(bucket_levels, "n int, key bigint, rows bigint")
    levels = levels.groupBy("n", "key").agg(F.sum("rows").alias("rows"))
    cuts = {r.n: r.key for r in crossing(levels, F.desc("key"), F.lit(tracked or 4 * size))}
    fullest = marked_buckets(counts, cuts, {})
    if fullest is None:
        return posts.sparkSession.createDataFrame([], TOTALS)
    known = land(added_up(posts, sizes, fullest), "fullest-totals")
    rank = F.row_number().over(Window.partitionBy("n").orderBy(F.desc("total")))
    reached = known.withColumn("_rank", rank).filter(F.col("_rank") == size).select("n", F.col("total").alias("least"))
    least = {r.n: r.least for r in reached.collect()}
    # Without a cut all buckets were among the fullest.
    rest = marked_buckets(counts, least, {n: cuts.get(n, 1) for n in sizes})
    if rest is not None:
        known = known.unionByName(added_up(posts, sizes, rest))
    floor = F.lit(1)
    for n, total in least.items():
        floor = F.when(F.col("n") == n, total).otherwise(floor)
    return known.filter(F.col("total") >= floor)


def rank_totals(posts: DataFrame, sizes: Sequence[int], size: int, direct: int = 5_000_000) -> DataFrame:
    """``(n, term, total, df)`` of all terms that may be among the ``size`` most frequent of their n.

    Up to ``direct`` occurrences of n-grams one pass that counts them all is
    cheaper than those of :func:`frequent_totals`; the top terms are the same.
    """
    words = posts.agg(F.sum(F.size(WORDS)).alias("n")).first().n or 0
    if words * len(sizes) <= direct:
        return all_totals(posts, *sizes, buckets=32)
    return frequent_totals(posts, sizes, size)


def crossing(counts: DataFrame, order: Column, wanted: Column) -> list:
    """Per n the first ``key`` at which the running sum of ``rows`` reaches what is wanted."""
    reached = F.sum("rows").over(Window.partitionBy("n").orderBy(order))
    passed = counts.withColumn("reached", reached).filter(F.col("reached") >= wanted)
    first = F.min_by(F.struct("key", "rows", (F.col("reached") - F.col("rows")).alias("before")), "reached")
    return passed.groupBy("n").agg(first.alias("at")).select("n", "at.*").collect()


def rank_cuts(totals: DataFrame, size: int) -> list[tuple[int, int, str, int]]:
    """``(n, total, prefix, width)``: where the rank ``size`` falls among the terms of each n.

    One histogram of totals for all n gives the total on which it falls. The
    terms with that total are counted by ever longer prefixes, until the prefix
    on which it falls holds at most ``size`` of them. An n without a row has
    no more terms than ``size``.
    """

    hist = totals.groupBy("n", F.col("total").alias("key")).agg(F.count("*").alias("rows"))
    # total, prefix, width, terms before, terms left
    state = {r.n: (r.key, "", 0, r.before, r.rows) for r in crossing(hist, F.desc("key"), F.lit(size))}
    while wide := {n: s for n, s in state.items() if s[4] > size}:
        ties, wanted, width = F.lit(False), F.lit(size), F.lit(0)
        for n, (total, prefix, w, before, _) in wide.items():
            mine = F.col("n") == n
            ties |= mine & (F.col("total") == total) & (F.left("term", F.lit(w)) == prefix)
            wanted = F.when(mine, size - before).otherwise(wanted)
            width = F.when(mine, w + 2).otherwise(width)
        heads = totals.filter(ties).groupBy("n", F.left("term", width).alias("key")).agg(F.count("*").alias("rows"))
        for r in crossing(heads, F.asc("key"), wanted):
            total, _, w, before, _ = wide[r.n]
            state[r.n] = (total, r.key, w + 2, before + r.before, r.rows)
    return [(n, total, prefix, w) for n, (total, prefix, w, _, _) in state.items()]


def top_of(totals: DataFrame, size: int) -> Column:
    """A filter that passes the ``size`` rows of largest total of each n, lower terms on ties.

    Nothing is sorted; passing rows may be up to ``size`` too many of each n.
    """
    dropped = F.lit(False)
    for n, total, prefix, width in rank_cuts(totals, size):
        head = F.left("term", F.lit(width)) <= prefix
        stays = (F.col("total") > total) | ((F.col("total") == total) & head)
        dropped |= (F.col("n") == n) & ~stays
    return ~dropped


def top_terms(totals: DataFrame, sizes: Sequence[int], size: int, keep: Sequence[str] = ()) -> DataFrame:
    """``(n, term, total, keep…, idx)`` of the ``size`` most frequent terms of each n.

    ``totals`` should be landed, it is read several times. ``idx`` counts from
    0; ties break by term, so the result does not depend on partitioning. The
    window sees at most twice ``size`` rows of each n.
    """
    wanted = totals.filter(F.col("n").isin(list(sizes)))
    by_rank = Window.partitionBy("n").orderBy(F.desc("total"), F.asc("term"))
    ranked = wanted.filter(top_of(wanted, size)).withColumn("idx", F.row_number().over(by_rank).cast("bigint") - 1)
    return ranked.filter(F.col("idx") < size).select("n", "term", "total", *keep, "idx")


def vocabulary(posts: DataFrame, n: int, size: int) -> DataFrame:
    """``(term, total, idx)``: top terms by total corpus count."""
    words = land(posts.select(WORDS), "vocabulary-words")
    totals = land(rank_totals(words, [n], size), "totals")
    return top_terms(totals, [n], size).select("term", "total", "idx")


def idf(df: str | Column, n_docs: int | Column, min_doc_freq: int) -> Column:
    """``ln((N + 1) / (df + 1))``, and 0 for terms rarer than the minimum."""
    df = F.col(df) if isinstance(df, str) else df
    n_docs = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    weight = F.log((n_docs + 1).cast("double") / (df + 1).cast("double"))
    return F.when(df < min_doc_freq, 0.0).otherwise(weight)


def weighted_vocabulary(
    posts: DataFrame, max_n: int, size: int, n_docs: int | Column, min_doc_freq: int
) -> DataFrame:
    """``(n, idx, term, total, df, idf, feature)`` for n = 1..max_n.

    ``feature`` numbers the slots of the assembled vector: n-major blocks of
    ``size`` slots each, in vocabulary order. ``posts`` should be landed: its
    words are read several times.
    """
    sizes = range(1, max_n + 1)
    totals = land(rank_totals(posts, sizes, size), "totals")
    return top_terms(totals, sizes, size, ["df"]).select(
        "n",
        "idx",
        "term",
        "total",
        "df",
        idf("df", n_docs, min_doc_freq).alias("idf"),
        ((F.col("n") - 1).cast("bigint") * size + F.col("idx")).alias("feature"),
    )


def known_terms(
    posts: DataFrame,
    vocab: DataFrame,
    max_n: int,
    keep: Sequence[str] = ("doc_id",),
    columns: Sequence[str] | None = None,
    most: int = MOST_MARKED,
) -> DataFrame:
    """Term counts of the posts limited to vocabulary terms, in one pass: ``keep``, ``tf`` and the vocabulary's columns.

    ``vocab`` should be a landed table; ``columns`` are those wanted of it, all
    if not named. Tasks sieve the n-grams by the buckets of its terms before
    they make text of them. While its terms are ``most`` at most they are
    broadcast and looked up inside the tasks, without a shuffle; more of them,
    or a term of several rows, are joined.
    """
    sizes, columns = range(1, max_n + 1), list(columns or vocab.columns)
    named = vocab.filter(F.col("term").isNotNull()).select("term", *[c for c in columns if c != "term"])
    held = named.limit(most + 1).toArrow()
    if held.num_rows > most or pc.count_distinct(held.column("term")).as_py() < held.num_rows:
        counted = term_counts(posts, *sizes, keep=keep, wanted=marked_terms(vocab))
        return counted.join(named, "term").select(*keep, "tf", *columns)
    context, rows = posts.sparkSession.sparkContext, posts.select(*keep, WORDS)
    marks = context.broadcast(term_marks(held.column("term").to_pylist()))
    count = known_counter(sizes, WORDS, list(keep), columns, context.broadcast(held), marks)
    schema = StructType([*rows.schema.fields[:-1], StructField("tf", LongType()), *named.select(*columns).schema.fields])
    return rows.mapInArrow(count, schema)


def tfidf(
    posts: DataFrame,
    vocab: DataFrame,
    max_n: int,
    keep: Sequence[str] = ("doc_id",),
    columns: Sequence[str] = ("n", "term", "feature"),
) -> DataFrame:
    """``(keep…, n, term, feature, tf, tfidf)``, or others of the vocabulary's columns: the sparse vectors in long form."""
    found = known_terms(posts, vocab, max_n, keep, [*columns, "idf"])
    return found.select(*keep, *columns, "tf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def linear_score(
    posts: DataFrame,
    vocab: DataFrame,
    coefficients: DataFrame,
    max_n: int,
    intercept: float = 0.0,
    threshold: float = 0.5,
    keep: Sequence[str] = ("doc_id",),
    most_terms: int = MOST_MARKED,
) -> DataFrame:
    """``keep`` and margin, probability and prediction of every post.

    A post without a known feature has the intercept as its margin. While the
    weighted terms are ``most_terms`` at most they are broadcast and the margin
    is a sum inside the row; more of them are joined.
    """
    weights = vocab.join(coefficients, "feature").select("term", (F.col("idf") * F.col("coefficient")).alias("weight"))
    weights = land(weights.filter("weight <> 0"), "term-weights")
    if weights.count() <= most_terms:
        held = [(r.term, r.weight) for r in weights.orderBy("term").collect()]
        shared = [[t for t, _ in held], [w for _, w in held]]
        context, rows = posts.sparkSession.sparkContext, posts.select(*keep, WORDS)
        count = margin_counter(
            range(1, max_n + 1), WORDS, list(keep), context.broadcast(shared), context.broadcast(term_marks(shared[0])), intercept
        )
        schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1]], "margin double"])
        scored = rows.mapInArrow(count, schema)
    else:
        scored = joined_margins(posts, weights, max_n, intercept, keep)
    probability = 1 / (1 + F.exp(-F.col("margin")))
    return scored.withColumn("probability", probability).withColumn(
        "prediction", F.when(F.col("probability") > threshold, 1.0).otherwise(0.0)
    )


def joined_margins(
    posts: DataFrame, weights: DataFrame, max_n: int, intercept: float, keep: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Margins by a join with the weighted terms, however many they are.

    Posts are told apart by their place in ``posts``, which must be a landed
    table: two posts with one id stay two rows. A post's terms come from one
    row, so the map-side combine leaves one row per post for the shuffle.
    """
    placed = posts.withColumn("_post", F.monotonically_increasing_id())
    found = known_terms(placed, weights, max_n, ("_post",), ["weight"], most=0)
    dots = found.groupBy("_post").agg(F.sum(F.col("tf") * F.col("weight")).alias("_dot"))
    margin = F.coalesce("_dot", F.lit(0.0)) + F.lit(intercept)
    return placed.select("_post", *keep).join(dots, "_post", "left").select(*keep, margin.alias("margin"))
