"""Mixing sources to target weights with nested hash thresholds.

Every document has a hash. A source's target is met by the documents whose hash
is below a threshold: a histogram of tokens by source and leading hash bits
tells in which bucket the budget runs out, and only that bucket's documents are
counted again by their next bits, until one hash is left. Nothing is sorted.

Sizes are words ``[^\\x20\\x09-\\x0D]+`` of the text; null and empty texts have
none. Sources are ranked by code point, null last; an absent source is a source
like any other. Where a target is above its source's size, all documents are
taken once or twice and the threshold decides on the rest. The document on
which the budget runs out is taken if that comes closer to the target. Rows of
one doc_id share its hash and are taken together. An empty table gives no rows.
"""

from __future__ import annotations

import functools

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tidemark.llm.common import documents, free_name, land, raw_text

HASH_BITS = 52
WEIGHTS = (5.0, 2.0, 1.0)


@F.pandas_udf(T.LongType())
def word_count(texts: pd.Series) -> pd.Series:
    # bytes.split() cuts at blank and \t..\r, the white space of the definition.
    return texts.map(lambda t: len(t.split())).astype("int64")


def document_hash(id_col: str) -> Column:
    """52 bits of the MD5 of the doc_id as text: the same in every engine."""
    digits = F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), 1, HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most_copies: int) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``: one row per source.

    Sharing the excess again and again ends where every source gets
    ``level * weight`` or its cap. With sources in order of cap / weight, the
    level is that of the first source that it does not fill; later ones give less.
    """
    ranked = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    turn = (F.row_number().over(ranked) - 1) % len(weights)
    weight = functools.reduce(
        lambda rest, i: F.when(turn == i, F.lit(weights[i])).otherwise(rest), range(1, len(weights)), F.lit(weights[0])
    )
    rows = (
        sizes.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * most_copies)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("filled", F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("open", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("budget", F.sum("source_size").over(everything) * share)
        .withColumn("level", (F.col("budget") - F.col("filled")) / F.col("open"))
    )
    level = F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything)
    return rows.withColumn("level", level).select(
        "source",
        "source_size",
        F.coalesce(F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")), F.lit(0.0)).alias("target"),
    )


def same_source(left: DataFrame, right: DataFrame) -> Column:
    return left["source"].eqNullSafe(right["source"])


def thresholds(sized: DataFrame, targets: DataFrame, bits: int = 12) -> DataFrame:
    """``source, source_size, target, whole, below``: copies of all documents, and the hash
    below which a document is taken once more."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = targets.withColumn("whole", whole.cast("bigint")).select(
        "*",
        (F.col("target") - F.col("whole") * F.col("source_size")).alias("rest"),
        F.lit(0).cast("bigint").alias("taken"),
        F.lit(0).cast("bigint").alias("prefix"),
        F.lit(None).cast("bigint").alias("below"),
    )
    state = land(state, "mix-targets")
    shift = HASH_BITS
    while shift > 0:
        # Only documents of an undecided bucket are counted.
        outer, shift = shift, max(0, shift - bits)
        asked = state.filter(F.col("below").isNull()).select(
            F.col("source").alias("at"), "prefix", "taken", "rest"
        )
        inside = sized.join(
            asked,
            sized["source"].eqNullSafe(F.col("at"))
            & (F.shiftrightunsigned("hash", min(outer, 63)) == F.col("prefix")),
        )
        buckets = inside.groupBy("at", F.shiftrightunsigned("hash", shift).alias("bucket")).agg(
            F.sum("size").alias("tokens"),
            F.min("hash").alias("least"),
            F.max("hash").alias("largest"),
            F.first("taken").alias("taken"),
            F.first("rest").alias("rest"),
        )
        running = Window.partitionBy("at").orderBy("bucket")
        before = F.sum("tokens").over(running) - F.col("tokens") + F.col("taken")
        edge = (
            buckets.withColumn("before", before)
            .filter(F.col("before") + F.col("tokens") > F.col("rest"))
            .groupBy("at")
            .agg(F.min(F.struct("bucket", "before", "tokens", "least", "largest")).alias("edge"))
        )
        joined = state.join(edge, state["source"].eqNullSafe(edge["at"]), "left")
        fits = 2 * (F.col("edge.before")) + F.col("edge.tokens") <= 2 * F.col("rest")
        found = (
            F.when(F.col("below").isNotNull(), F.col("below"))
            .when(F.col("edge").isNull(), F.lit(1 << HASH_BITS))
            .when(F.col("edge.least") == F.col("edge.largest"), F.col("edge.least") + fits.cast("bigint"))
        )
        state = land(
            joined.select(
                "source", "source_size", "target", "whole", "rest",
                F.coalesce("edge.before", "taken").alias("taken"),
                F.coalesce("edge.bucket", "prefix").alias("prefix"),
                found.alias("below"),
            ),
            "mix-thresholds",
        )
        if state.filter(F.col("below").isNull()).isEmpty():
            break
    return state.select("source", "source_size", "target", "whole", "below")


def sized_rows(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        word_count(raw_text(text_col)).alias("size"),
        document_hash(id_col).alias("hash"),
    )


def plan_mix(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most_copies: int = 2) -> DataFrame:
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return thresholds(sized, source_targets(sizes, weights, share, most_copies))


def mix_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``."""
    sized = land(sized_rows(docs, id_col, text_col, source_col), "mix-sizes")
    plan = plan_mix(sized, **how)
    copies = F.col("whole") + (F.col("hash") < F.col("below")).cast("bigint")
    return sized.join(plan, same_source(sized, plan)).select(
        "doc_id",
        sized["source"],
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (F.col("size") * copies).alias("taken"),
    )


def mixed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The documents of the mix with all their columns, a row for each copy."""
    sized = land(sized_rows(docs, id_col, text_col, source_col), "mix-sizes")
    plan = plan_mix(sized, **how)
    name = {c: free_name(docs, f"_{c}") for c in ("source", "whole", "below", "hash", "copy")}
    limits = plan.select(*[F.col(c).alias(name[c]) for c in ("source", "whole", "below")])
    rows = docs.withColumn(name["hash"], document_hash(id_col))
    copies = F.col(name["whole"]) + (F.col(name["hash"]) < F.col(name["below"])).cast("bigint")
    joined = rows.join(limits, rows[source_col].eqNullSafe(limits[name["source"]]))
    return (
        joined.filter(copies > 0)
        .withColumn(name["copy"], F.explode(F.array_repeat(F.lit(1), copies.cast("int"))))
        .select(*docs.columns)
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    report = mix_report(documents(spark, sf_dir))
    return report.select("doc_id", "size", "source_size", "target", "taken")


OP9_SQL = """
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || left(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 13) AS BIGINT) AS hash
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         list_extract([5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE],
                      CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS INT)) AS weight
  FROM sized GROUP BY source
), ratios AS (
  SELECT *, 2 * source_size / weight AS ratio FROM sources
), levels AS (
  SELECT *,
         (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(2 * source_size) OVER (
            ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ratios
), targets AS (
  SELECT source, source_size,
         coalesce(least(CAST(2 * source_size AS DOUBLE),
                        max(CASE WHEN level <= ratio THEN level END) OVER () * weight), 0) AS target
  FROM levels
), parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets
), groups AS (
  SELECT source, hash, CAST(sum(size) AS BIGINT) AS tokens FROM sized GROUP BY source, hash
), running AS (
  SELECT source, hash, tokens, sum(tokens) OVER (PARTITION BY source ORDER BY hash) - tokens AS before FROM groups
)
SELECT d.doc_id, d.size, p.source_size, p.target,
       CAST(d.size * (p.whole + CASE WHEN 2 * r.before + r.tokens <= 2 * (p.target - p.whole * p.source_size)
                                     THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized d
JOIN parts p ON d.source IS NOT DISTINCT FROM p.source
JOIN running r ON r.source IS NOT DISTINCT FROM d.source AND r.hash = d.hash
"""
