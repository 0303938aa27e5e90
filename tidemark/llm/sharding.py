"""Sharding by sampled splitters.

Documents are ordered by the hash of their text, so equal texts are neighbours.
A sample weighted by size (half) and by rows (half) gives quantiles that cut the
order into many more ranges than shards; a text that fills several ranges is cut
by doc_id. Ranges that still hold more than four times their share are sampled
and cut again. Sums within each range and over the ranges give every document
its place in the whole order, and the place in bytes divided by a shard's share
is the shard.

A text's copies go to one shard unless they hold more than ``whole_share`` of
one, or fill a range. Sizes are UTF-8 bytes plus 8; null counts as empty. Rows
that repeat doc_id and text are ordered by where they stand in the input. An
empty table gives no rows. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import documents, land, long_array, text_crc

LEAST = -(1 << 63)
Cut = tuple[int, int, int]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Everything the later steps need, without the text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        text_crc(text_col).alias("text_crc32"),
        F.struct(
            F.xxhash64(text).alias("k"),
            F.xxhash64(F.col(id_col)).alias("r"),
            F.monotonically_increasing_id().alias("t"),
        ).alias("key"),
    )


def splitters(rows: DataFrame, ranges: int, per_range: int, seed: int) -> list[Cut]:
    """Keys at the quantiles of a sample of about ``ranges * per_range`` rows.

    A cut lies before all rows of its text, unless the cut before it lies in
    the same text.
    """
    total = rows.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).first()
    if not total.rows:
        return []
    share = F.col("size") / (2.0 * total.bytes) + 1 / (2.0 * total.rows)
    chance = F.least(F.lit(1.0), share * (ranges * per_range))
    sample = rows.withColumn("share", share / chance).filter(F.rand(seed) < chance)
    order = Window.orderBy("key")
    cell = F.floor(F.sum("share").over(order) * ranges)
    quantiles = sample.withColumn("cell", cell).groupBy("cell").agg(F.min("key").alias("key"))
    same_text = F.lag("key.k").over(Window.orderBy("key")) == F.col("key.k")
    rest = [F.when(same_text, F.col(f"key.{c}")).otherwise(LEAST).alias(c) for c in ("r", "t")]
    return [tuple(row) for row in quantiles.select("key.k", *rest).collect()]


def range_of(cuts: list[Cut], key: Column) -> Column:
    """How many of the cuts are at or below the key: a binary search."""
    k, r, t = (long_array([c[i] for c in sorted(set(cuts))]) for i in range(3))
    steps = long_array([1 << i for i in reversed(range(max(len(cuts), 1).bit_length()))])

    def at_or_below(i: Column) -> Column:
        same_r = (F.get(r, i) == key["r"]) & (F.get(t, i) <= key["t"])
        return (F.get(k, i) < key["k"]) | ((F.get(k, i) == key["k"]) & ((F.get(r, i) < key["r"]) | same_r))

    def advance(at: Column, step: Column) -> Column:
        return F.when((at + step <= F.size(k)) & at_or_below((at + step - 1).cast("int")), at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0).cast("bigint"), advance)


def cut_ranges(rows: DataFrame, ranges: int, per_range: int, overfull: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """The rows with their range, and bytes and rows of each range.

    Overfull ranges are cut again from a sample of their own; the key tells all
    rows apart. It ends when none is left, or when three samples in a row gave
    no new cut (a range of a very long text and little else): such a range
    takes its task longer and changes no result.
    """
    total = rows.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).first()
    cuts = splitters(rows, ranges, per_range, seed)
    idle = 0
    while True:
        # Landed, as the range is joined on: a join on the search itself fails in Spark 4.1 (its inferred
        # filter asks the other side for the key), and would repeat the search.
        placed = land(rows.withColumn("range", range_of(cuts, F.col("key"))), "shard-ranged")
        held = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        held = land(held, "shard-ranges")
        much = (F.col("bytes") * ranges > overfull * (total.bytes or 0)) | (
            F.col("rows") * ranges > overfull * total.rows
        )
        full = land(held.filter(much & (F.col("rows") > 1)).select("range"), "shard-overfull")
        n_full = full.count()
        if not n_full or idle == 3:
            return placed, held
        seed += 1
        more = splitters(placed.join(full, "range", "left_semi"), 16 * n_full, per_range, seed)
        idle = idle + 1 if set(more) <= set(cuts) else 0
        cuts = sorted(set(cuts) | set(more))


def assign_shards(
    docs: DataFrame,
    shards: int = 24,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows_per_range: int = 1_000_000,
    ranges_per_shard: int = 8,
    per_range: int = 16,
    overfull: float = 4.0,
    whole_share: float = 0.01,
    seed: int = 7,
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row.

    The law is ``bytes``: a shard's size differs from the mean by at most
    ``whole_share`` of it and one document.
    """
    rows = land(keyed(docs, id_col, text_col), "shard-keys")
    ranges = max(shards * ranges_per_shard, -(-rows.count() // rows_per_range))
    placed, held = cut_ranges(rows, ranges, per_range, overfull, seed)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = land(
        held.select(
            "range",
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
            F.sum("bytes").over(Window.partitionBy()).alias("total"),
        ),
        "shard-bases",
    )
    order = Window.partitionBy("range").orderBy("key.k", "key.r", "key.t")
    text = Window.partitionBy("range", "key.k")
    start = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    ranked = (
        placed.withColumn("start", start)
        .withColumn("number", F.row_number().over(order) - 1)
        .withColumn("text_bytes", F.sum("size").over(text))
        .withColumn("text_start", F.min("start").over(text))
        .join(bases, "range")
    )
    whole = F.col("text_bytes") * shards <= F.col("total") * whole_share
    # A document, or a text kept whole, goes where its middle lies.
    middle = F.when(whole, F.col("text_start") + F.col("text_bytes") / 2).otherwise(F.col("start") + F.col("size") / 2)
    place = F.col("bytes_before") + middle
    numbered = land(
        ranked.select(
            "doc_id",
            "size",
            "text_crc32",
            F.least(F.floor(place * shards / F.col("total")), F.lit(shards - 1)).cast("int").alias("shard"),
            (F.col("rows_before") + F.col("number")).alias("number"),
        ),
        "shard-places",
    )
    first = land(numbered.groupBy("shard").agg(F.min("number").alias("first")), "shard-starts")
    return numbered.join(first, "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("number") - F.col("first")).alias("slot")
    )


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes."""
    return assign_shards(documents(spark, sf_dir)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
