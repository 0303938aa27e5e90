"""A bounded filter of keys that need a join, so that all other rows are spared it.

Duplicates are few among many documents. Rows whose key is surely not among the
marked keys pass as they are; only the others, with a few false alarms, are
shuffled to meet their group. The filter is built in slices and has at most
``most_bytes``: with more keys there are more false alarms, and the result
stays the same.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

SLICES = 64
BITS_PER_KEY = 16


def places(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit positions of 64-bit hashes within a slice of ``size`` bits."""
    return keys & np.uint64(size - 1), (keys >> np.uint64(29)) & np.uint64(size - 1)


def slice_of(key: Column) -> Column:
    return F.shiftrightunsigned(key, 58)


def build(marked: DataFrame, most_bytes: int) -> np.ndarray:
    """Bits of all ``key`` (bigint hash) rows, a row of bytes for each slice."""
    wanted = BITS_PER_KEY * max(64, marked.count() // SLICES)
    size = min(1 << (wanted - 1).bit_length(), most_bytes * 8 // SLICES)

    def fill(group: pa.Table) -> pa.Table:
        bits = np.zeros(size, bool)
        for place in places(group.column("key").to_numpy().view(np.uint64), size):
            bits[place] = True
        row = [group.column("slice")[0].as_py(), np.packbits(bits, bitorder="little").tobytes()]
        return pa.table({"slice": pa.array(row[:1], pa.int64()), "bits": pa.array(row[1:], pa.binary())})

    keys = marked.select(slice_of(F.col("key")).alias("slice"), "key")
    out = np.zeros((SLICES, size // 8), np.uint8)
    for row in keys.groupBy("slice").applyInArrow(fill, "slice bigint, bits binary").collect():
        out[row["slice"]] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return out


def maybe(marked: DataFrame, most_bytes: int = 16 * 1024 * 1024):
    """A function of a bigint hash column: false where the key is surely not marked."""
    table = marked.sparkSession.sparkContext.broadcast(build(marked, most_bytes))

    @F.pandas_udf(T.BooleanType())
    def known(keys: pd.Series) -> pd.Series:
        hashes = keys.to_numpy(np.int64).view(np.uint64)
        data = table.value
        at = (hashes >> np.uint64(58)).astype(np.int64)
        found = np.ones(len(hashes), bool)
        for place in places(hashes, data.shape[1] * 8):
            found &= (data[at, (place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return pd.Series(found)

    return known
