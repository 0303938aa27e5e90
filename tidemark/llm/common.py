"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import land

__all__ = ["documents", "free_name", "land", "long_array", "one_of_each", "raw_text", "remainder", "slices", "sorted_place", "table", "text_crc"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def raw_text(text: str) -> Column:
    """UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


def text_crc(text: str) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; 0 for null and empty."""
    return F.crc32(raw_text(text))


def remainder(key: str, modulus: int) -> Column:
    """crc32 of a key written as text, modulo: the folds of the contracts."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % modulus


def long_array(values) -> Column:
    """A constant array, folded to a literal before the plan runs."""
    if not values:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(",".join(str(int(v)) for v in values)), ",").cast("array<bigint>")


def sorted_place(cuts, value: Column) -> Column:
    """How many of the sorted cuts lie below the value: a binary search; 0 for null."""
    bounds = long_array(cuts)
    steps = long_array([1 << i for i in reversed(range(max(len(cuts), 1).bit_length()))])

    def advance(at: Column, step: Column) -> Column:
        below = F.get(bounds, (at + step - 1).cast("int")) < value
        return F.when((at + step <= F.size(bounds)) & below, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0).cast("bigint"), advance)


def slices(batch: pa.RecordBatch, column: str, budget: int) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of consecutive values of at most ``budget`` bytes, and where each begins.

    A value longer than the budget is a run of its own, so what a task holds
    at once is bounded by the budget and by its longest text.
    """
    values = batch.column(column).cast(pa.binary())
    if not len(values):
        return
    sizes = np.diff(np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1])
    begin, held = 0, 0
    for end, size in enumerate(sizes.tolist()):
        if end > begin and held + size > budget:
            yield begin, values.slice(begin, end - begin).to_pylist()
            begin, held = end, 0
        held += size
    if begin < len(values):
        yield begin, values.slice(begin).to_pylist()


def one_of_each(rows: DataFrame, keys: list[str], repeats: str) -> DataFrame:
    """Keep one row for each key.

    ``repeats`` holds the number of rows of the row's key. Rows that are alone,
    nearly all, pass without a shuffle.
    """
    alone = rows.filter(F.col(repeats) == 1)
    return alone.unionByName(rows.filter(F.col(repeats) > 1).dropDuplicates(keys))
