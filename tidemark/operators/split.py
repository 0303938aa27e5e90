"""Train/test split and sampling.

The default assigns a row by a hash of its key, so the result is the same for
every partitioning, file layout and re-run of a lost task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Shares and seeds.
TRAIN_SHARE = 0.8
SPLIT_SEED = 2000
TRAIN_SAMPLE_SEED = 43
TEST_SAMPLE_SEED = 44

_BUCKETS = 1_000_000


def key_bucket(key: str | Column, seed: int) -> Column:
    """A bucket in 0..999999 from the seed and the key; null counts as empty."""
    key = F.col(key) if isinstance(key, str) else key
    name = F.coalesce(key.cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % _BUCKETS


def in_share(key: str | Column, share: float, seed: int) -> Column:
    return key_bucket(key, seed) < round(share * _BUCKETS)


def with_split(
    rows: DataFrame, key: str, share: float = TRAIN_SHARE, seed: int = SPLIT_SEED
) -> DataFrame:
    return rows.withColumn("split", F.when(in_share(key, share, seed), "train").otherwise("test"))


def hash_split(
    rows: DataFrame, key: str, share: float = TRAIN_SHARE, seed: int = SPLIT_SEED
) -> tuple[DataFrame, DataFrame]:
    chosen = in_share(key, share, seed)
    return rows.filter(chosen), rows.filter(~chosen)


def hash_sample(rows: DataFrame, key: str, share: float, seed: int) -> DataFrame:
    """A sample without replacement, keyed like the split."""
    return rows.filter(in_share(key, share, seed))


def split_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("split").agg(F.count("*").alias("n"))
