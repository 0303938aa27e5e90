"""SimHash near-duplicates by tiled exact comparison.

A text's fingerprint has a bit set where over half of the hashes of its
three-word shingles have it set. Distinct fingerprints, each standing for the
smallest doc_id that has it, are ordered by the population counts of their
quarters and cut into tiles. Two tiles are compared, every pair by exclusive-or
and bit count, unless the gaps between their ranges of population counts sum to
more than the radius: no pair of theirs can then link. A tile pair reports a
forest of the links it found, not the links, and the components are those of
all forests.

A-Z are lower-cased, words are ``[^\\x20\\x09-\\x0D]+``; a text of fewer words
than a shingle is one shingle; null, empty and blank texts have fingerprint
zero and link like any other. A null doc_id is below all others. An empty table
gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.llm.common import documents, free_name, land, one_of_each, raw_text, sorted_place
from tidemark.llm.graph import Forest, components, link_rows
from tidemark.llm.marked import maybe

SEED = 42
NO_ID = np.iinfo(np.int64).min
QUARTERS = 4
# Shingles of a long text counted at once.
SHINGLES_AT_ONCE = 255 * 256


def bit_counts(digests: bytes) -> np.ndarray:
    """How many of the 8-byte digests have each of 64 bits set."""
    bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
    even = len(bits) - len(bits) % 255
    # 255 ones still fit a byte, so most of the adding needs no wider type.
    sums = bits[:even].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return sums + bits[even:].sum(axis=0, dtype=np.uint8)


def fingerprint(text: bytes, width: int = 3) -> int:
    """The fingerprint as a signed 64-bit integer."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < width:
        words, width = [b" ".join(words)], 1
    n = len(words) - width + 1
    counts, digest = np.zeros(64, np.int64), xxhash.xxh64_digest
    for first in range(0, n, SHINGLES_AT_ONCE):
        run = words[first : first + SHINGLES_AT_ONCE + width - 1]
        shingles = map(b" ".join, zip(*(run[i:] for i in range(width))))
        counts += bit_counts(b"".join([digest(s, SEED) for s in shingles]))
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big", signed=True)


def printer(width: int):
    @F.pandas_udf(T.LongType())
    def prints(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: fingerprint(text, width)).astype("int64")

    return prints


fingerprints = printer(3)


def population(prints: np.ndarray) -> np.ndarray:
    """Bit counts of the 16-bit quarters, a column for each."""
    return np.bitwise_count(np.ascontiguousarray(prints).view(np.uint16).reshape(-1, QUARTERS)).astype(np.int32)


TILES = "tile bigint, low array<int>, high array<int>, prints binary, docs binary"


def tiler(size: int):
    """One range of the order to tiles of at most ``size``, numbered within it."""

    def tile(group: pa.Table) -> pa.Table:
        group = group.sort_by([("order", "ascending"), ("print", "ascending")])
        at = group.column("range")[0].as_py() << 32
        prints, docs = (group.column(c).to_numpy() for c in ("print", "doc"))
        rows = []
        for k, begin in enumerate(range(0, len(prints), size)):
            part = prints[begin : begin + size]
            counts = population(part)
            low, high = counts.min(axis=0).tolist(), counts.max(axis=0).tolist()
            rows.append((at + k, low, high, part.tobytes(), docs[begin : begin + size].tobytes()))
        kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
        return pa.Table.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["tile", "low", "high", "prints", "docs"]
        )

    return tile


def order_key(prints: np.ndarray) -> np.ndarray:
    """Total population count, then those of the quarters, then leading bits, as one integer."""
    counts = population(prints).astype(np.int64)
    key = counts.sum(axis=1)
    for quarter in range(QUARTERS):
        key = key << 5 | counts[:, quarter]
    return key << 36 | (prints.view(np.uint64) >> np.uint64(28)).astype(np.int64)


@F.pandas_udf(T.LongType())
def ordered(prints: pd.Series) -> pd.Series:
    return pd.Series(order_key(np.ascontiguousarray(prints.to_numpy(np.int64))))


def make_tiles(prints: DataFrame, size: int) -> DataFrame:
    """Tiles of ``print, doc`` rows: the order is cut at quantiles, about ``size`` rows apart.

    A range that the quantiles, which are approximate, leave larger becomes
    several tiles.
    """
    rows = land(prints.withColumn("order", ordered("print")), "ordered-prints")
    n = max(1, -(-rows.count() // size))
    marks = [i / n for i in range(1, n)]
    cuts = rows.agg(F.percentile_approx("order", marks, 20 * n)).first()[0] if marks else []
    found = sorted_place(sorted(set(cuts or [])), F.col("order"))
    return land(rows.withColumn("range", found).groupBy("range").applyInArrow(tiler(size), TILES), "tiles")


def tile_pairs(tiles: DataFrame, radius: int) -> DataFrame:
    """``one, other`` (one <= other) of the tiles whose population counts come within the radius.

    The pairs meet on the lowest total count that both can have, give or take
    the radius; the quarters then rule out most of them.
    """
    low, high = (F.aggregate(c, F.lit(0), lambda x, y: x + y) for c in ("low", "high"))
    spans = tiles.select("tile", "low", "high", low.alias("least"), high.alias("most"))

    def side(name: str, k: int, counts) -> DataFrame:
        columns = [F.col(c).alias(f"{c}{k}") for c in ("low", "high", "least")]
        return spans.select(F.col("tile").alias(name), *columns, F.explode(counts).alias("count"))

    one = side("one", 1, F.sequence("least", "most"))
    other = side("other", 2, F.sequence(F.col("least") - radius, F.col("most") + radius))
    gaps = [
        F.greatest(F.col("low1")[q] - F.col("high2")[q], F.col("low2")[q] - F.col("high1")[q], F.lit(0))
        for q in range(QUARTERS)
    ]
    first = F.col("count") == F.greatest(F.col("least1"), F.col("least2") - radius)
    near = sum(gaps[1:], gaps[0]) <= radius
    return one.join(other, "count").filter(first & (F.col("one") <= F.col("other")) & near).select("one", "other")


def compare(one: np.ndarray, other: np.ndarray, radius: int, same: bool, rows: int = 256) -> Forest:
    """The forest of links between two tiles, over the members of the first and then the second."""
    n = len(one)
    forest = Forest(n if same else n + len(other))
    for first in range(0, n, rows):
        hits = np.bitwise_count(one[first : first + rows, None] ^ other[None, :]) <= radius
        if same:
            hits &= np.arange(len(other))[None, :] > np.arange(first, first + len(hits))[:, None]
        if hits.any():
            link_rows(forest, hits, first, 0 if same else n)
    return forest


def comparer(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one, other, prints1, docs1, prints2, docs2 = (batch.column(c)[i].as_py() for c in range(6))
                same = one == other
                prints = [np.frombuffer(x, np.int64) for x in (prints1, prints2)]
                forest = compare(*prints, radius, same)
                docs = np.frombuffer(docs1 if same else docs1 + docs2, np.int64)
                edges = np.array(forest.edges(), np.int64).reshape(-1, 2)
                if len(edges):
                    yield pa.RecordBatch.from_arrays([pa.array(docs[edges[:, k]]) for k in (0, 1)], ["a", "b"])

    return run


def near_groups(prints: DataFrame, radius: int = 2, tile_size: int = 4096) -> DataFrame:
    """``print, component`` of every distinct fingerprint of ``doc, print`` rows."""
    distinct = land(prints.groupBy("print").agg(F.min("doc").alias("doc")), "fingerprints")
    tiles = make_tiles(distinct, tile_size)
    pairs = land(tile_pairs(tiles.select("tile", "low", "high"), radius), "tile-pairs")
    sides = [
        tiles.select(F.col("tile").alias(key), F.col("prints").alias(f"prints{k}"), F.col("docs").alias(f"docs{k}"))
        for k, key in ((1, "one"), (2, "other"))
    ]
    work = pairs.join(sides[0], "one").join(sides[1], "other")
    edges = work.select("one", "other", "prints1", "docs1", "prints2", "docs2").mapInArrow(comparer(radius), "a bigint, b bigint")
    found = components(land(edges, "near-links"))
    joined = distinct.join(found, distinct["doc"] == found["node"], "left")
    return joined.select("print", F.coalesce("component", "doc").alias("component"))


def keys(id_col: str):
    return F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID))


def simhash_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", radius: int = 2) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``."""
    prints = land(
        docs.select(keys(id_col).alias("doc"), fingerprints(raw_text(text_col)).alias("print")), "document-prints"
    )
    groups = land(near_groups(prints, radius), "near-groups")

    def named(column: str):
        return F.when(F.col(column) != F.lit(NO_ID), F.col(column))

    return prints.join(groups, "print").select(
        named("doc").alias("doc_id"),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        named("component").alias("component_id"),
    )


def one_per_group(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", radius: int = 2, width: int = 3
) -> DataFrame:
    """The document of smallest doc_id of each group, with all its columns.

    Only ids, hashes of texts and fingerprints are written. Documents whose id
    is surely in no group of several pass as they are (see ``marked``); the
    others, few, meet their group by id and hash. If rows share the doc_id that
    stays, one of them stays.
    """
    name = {c: free_name(docs, f"_{c}") for c in ("doc", "hash", "component", "rows")}
    text_hash = F.xxhash64(raw_text(text_col))
    prints = docs.select(keys(id_col).alias("doc"), text_hash.alias("hash"), printer(width)(raw_text(text_col)).alias("print"))
    prints = land(prints, "document-prints")
    sizes = prints.groupBy("print").agg(F.count("*").alias("n")).join(near_groups(prints, radius), "print")
    sizes = land(sizes, "near-groups")
    shared = sizes.groupBy("component").agg(F.sum("n").alias("members")).filter("members > 1")
    shared = land(sizes.join(shared, "component").select("print", "component"), "near-shared")
    members = land(prints.join(shared, "print").select("doc", "hash", "component"), "near-members")
    known = maybe(members.select(F.xxhash64("doc").alias("key")).distinct())(F.xxhash64(keys(id_col)))
    found = members.distinct().select(*[F.col(c).alias(name[c]) for c in ("doc", "hash", "component")])
    same = (keys(id_col) == F.col(name["doc"])) & (text_hash == F.col(name["hash"]))
    joined = docs.filter(known).join(found, same, "left")
    own = F.col(name["component"]).isNull() | (keys(id_col) == F.col(name["component"]))
    stay = joined.filter(own)
    heads = members.filter("doc = component").groupBy("component").count()
    repeats = heads.filter("count > 1").select(
        F.col("component").alias(name["component"]), F.col("count").alias(name["rows"])
    )
    repeats = land(repeats, "near-repeats")
    if not repeats.isEmpty():
        stay = stay.join(repeats, name["component"], "left")
        stay = stay.withColumn(name["rows"], F.coalesce(name["rows"], F.lit(1)))
        stay = one_of_each(stay, [name["component"]], name["rows"])
    return docs.filter(~known).select(*docs.columns).unionByName(stay.select(*docs.columns))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and near-duplicate groups of all documents."""
    return simhash_groups(documents(spark, sf_dir))
