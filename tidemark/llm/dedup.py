"""Exact deduplication with a cuckoo-filter index of live digests.

An index is a set of shards, each the leading bits of a SHA-256 digest. A shard
holds a cuckoo filter (16-bit fingerprints, four slots in a bucket) and the
stored digests themselves, bucketed like the filter. A digest that the filter
does not know is new; one that it seems to know is compared with the stored
digests of its two buckets. A full filter is rebuilt from the stored keys with
twice the buckets. Digests whose last document goes are deleted from both.

Texts are equal when identical after lower-casing A-Z; null counts as empty.
Of equal texts the largest doc_id stays, and of rows that share doc_id and text
one. An empty table gives no groups. A null doc_id is below all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import documents, free_name, land, one_of_each, raw_text
from tidemark.llm.marked import maybe

SLOTS = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_ID = np.iinfo(np.int64).min


class CuckooFilter:
    """Partial-key cuckoo hashing of digests; the number of buckets is a power of two."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.table: list[list[int]] = [[] for _ in range(buckets)]

    def places(self, digest: bytes) -> tuple[int, int, int]:
        """Fingerprint and both buckets; either bucket gives the other."""
        mark = int.from_bytes(digest[8:10], "little") or 1
        first = int.from_bytes(digest[10:18], "little") & (self.buckets - 1)
        return mark, first, self.other(first, mark)

    def other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & (self.buckets - 1)

    def __contains__(self, digest: bytes) -> bool:
        mark, first, second = self.places(digest)
        return mark in self.table[first] or mark in self.table[second]

    def insert(self, digest: bytes, most_moves: int = 200) -> bool:
        """False if no slot was found; the filter then lacks one stored mark and must be rebuilt."""
        mark, first, second = self.places(digest)
        for bucket in (first, second):
            if len(self.table[bucket]) < SLOTS:
                self.table[bucket].append(mark)
                return True
        bucket = second
        for move in range(most_moves):
            row = self.table[bucket]
            row[move % SLOTS], mark = mark, row[move % SLOTS]
            bucket = self.other(bucket, mark)
            if len(self.table[bucket]) < SLOTS:
                self.table[bucket].append(mark)
                return True
        return False

    def delete(self, digest: bytes) -> bool:
        mark, first, second = self.places(digest)
        for bucket in (first, second):
            if mark in self.table[bucket]:
                self.table[bucket].remove(mark)
                return True
        return False


class Shard:
    """A filter with the digests it stands for: digest to (documents, keeper, rows of the keeper)."""

    def __init__(self, buckets: int = 256):
        self.filter = CuckooFilter(buckets)
        self.stored: list[dict[bytes, tuple[int, int, int]]] = [{} for _ in range(buckets)]
        self.rebuilds = 0

    def home(self, digest: bytes) -> dict[bytes, tuple[int, int, int]]:
        return self.stored[self.filter.places(digest)[1]]

    def insert(self, digest: bytes, count: int, keeper: int, ties: int) -> None:
        content = self.home(digest)
        if digest in self.filter and digest in content:
            n, old, old_ties = content[digest]
            best = max(old, keeper)
            content[digest] = (n + count, best, old_ties * (old == best) + ties * (keeper == best))
            return
        content[digest] = (count, keeper, ties)
        if not self.filter.insert(digest):
            self.rebuild()

    def rebuild(self) -> None:
        """Twice the buckets, refilled from the stored keys, until all fit."""
        keys = [item for content in self.stored for item in content.items()]
        buckets = self.filter.buckets
        while True:
            buckets *= 2
            self.rebuilds += 1
            self.filter = CuckooFilter(buckets)
            if all(self.filter.insert(digest) for digest, _ in keys):
                break
        self.stored = [{} for _ in range(buckets)]
        for digest, value in keys:
            self.home(digest)[digest] = value

    def delete(self, digest: bytes, count: int) -> None:
        """``count`` documents of a digest go; its last one takes the digest along."""
        if digest not in self.filter:
            return
        content = self.home(digest)
        if digest not in content:
            return
        n, keeper, ties = content[digest]
        if n > count:
            content[digest] = (n - count, keeper, ties)
        else:
            del content[digest]
            self.filter.delete(digest)

    def items(self) -> Iterator[tuple[bytes, tuple[int, int, int]]]:
        for content in self.stored:
            yield from content.items()


def digest_texts(texts: pa.Array) -> pa.Array:
    """SHA-256 of each text with A-Z lower-cased; bytes.lower() changes nothing else."""
    lower = (t.as_py().lower() for t in texts)
    return pa.array([hashlib.sha256(t).digest() for t in lower], pa.binary())


def digested(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, digest`` of every row."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), digest_texts(batch.column("text"))], ["doc_id", "digest"]
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), raw_text(text_col).alias("text"))
    return rows.mapInArrow(digest, "doc_id bigint, digest binary")


def combined(most: int, shards: int):
    """Tasks: equal digests of a task become one row, so copies shrink before the shuffle.

    ``most`` bounds the table of a task; beyond it the rows so far are passed on.
    """

    def flush(table: dict[bytes, tuple[int, int, int]]) -> pa.RecordBatch:
        digests = list(table)
        counts, keepers, ties = (list(c) for c in zip(*table.values()))
        shard = [int.from_bytes(d[:8], "big") % shards for d in digests]
        columns = [pa.array(shard, pa.int64()), pa.array(digests, pa.binary())]
        columns += [pa.array(c, pa.int64()) for c in (counts, keepers, ties)]
        return pa.RecordBatch.from_arrays(columns, ["shard", "digest", "n", "keeper", "ties"])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[bytes, tuple[int, int, int]] = {}
        for batch in batches:
            for key, digest in zip(batch.column("doc_id").to_pylist(), batch.column("digest").to_pylist()):
                key = NO_ID if key is None else key
                n, keeper, ties = table.get(digest, (0, key, 0))
                best = max(keeper, key)
                table[digest] = (n + 1, best, ties * (keeper == best) + (key == best))
            if len(table) > most:
                yield flush(table)
                table = {}
        if table:
            yield flush(table)

    return combine


PARTIAL = "shard bigint, digest binary, n bigint, keeper bigint, ties bigint"


def index_shard(table: pa.Table) -> pa.Table:
    """Run one shard's changes, in order of digest, through its filter and stored keys.

    Rows with a negative ``n`` delete. The group is bounded: a shard is a share
    of the digests, and copies have become at most a row for each task.
    """
    shard = Shard()
    columns = [table.column(c).to_pylist() for c in ("digest", "n", "keeper", "ties")]
    changes = list(zip(*columns))
    for digest, n, keeper, ties in changes:
        if n > 0:
            shard.insert(digest, n, keeper, ties)
    for digest, n, _, _ in changes:
        if n < 0:
            shard.delete(digest, -n)
    live = sorted(shard.items())
    at = table.column("shard")[0].as_py()
    values = [list(c) for c in zip(*(v for _, v in live))] or [[], [], []]
    data = [pa.array([at] * len(live), pa.int64()), pa.array([d for d, _ in live], pa.binary())]
    return pa.Table.from_arrays([*data, *(pa.array(v, pa.int64()) for v in values)], ["shard", "digest", "n", "keeper", "ties"])


def shard_count(rows: int, keys_per_shard: int) -> int:
    return max(64, -(-rows // keys_per_shard))


def build_index(digests: DataFrame, keys_per_shard: int = 50_000, held: int = 100_000) -> DataFrame:
    """The live digests of ``doc_id, digest`` rows: ``shard, digest, n, keeper, ties``."""
    shards = shard_count(digests.count(), keys_per_shard)
    partial = digests.mapInArrow(combined(held, shards), PARTIAL)
    return partial.groupBy("shard").applyInArrow(index_shard, PARTIAL)


def change_index(index: DataFrame, added: DataFrame, removed: DataFrame, shards: int, held: int = 100_000) -> DataFrame:
    """The index after documents came and went; all are ``doc_id, digest`` rows.

    The keeper of a group is the largest doc_id it ever held; a caller who
    deletes keepers and needs a live one looks the group up in the documents.
    """
    gone = removed.mapInArrow(combined(held, shards), PARTIAL).withColumn("n", -F.col("n"))
    come = added.mapInArrow(combined(held, shards), PARTIAL)
    return index.unionByName(come).unionByName(gone).groupBy("shard").applyInArrow(index_shard, PARTIAL)


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keys_per_shard: int = 50_000) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Rows that repeat doc_id and text are told alike and all kept; ``distinct_rows``
    keeps one of them. Only groups of two or more take part in the join back.
    """
    digests = land(digested(docs, id_col, text_col), "digests")
    groups = land(build_index(digests, keys_per_shard).filter("n > 1").select("digest", "n", "keeper"), "digest-groups")
    keeper = F.when(F.col("keeper") != F.lit(NO_ID), F.col("keeper"))
    keep_id = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(keeper)
    return digests.join(groups, "digest", "left").select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def distinct_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keys_per_shard: int = 50_000) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Documents whose id is surely not in a group of several pass without a
    shuffle (see ``marked``); the others are joined with their group.
    """
    digests = land(digested(docs, id_col, text_col), "digests")
    groups = land(build_index(digests, keys_per_shard).filter("n > 1").select("digest", "n", "keeper", "ties"), "digest-groups")
    name = {c: free_name(docs, f"_{c}") for c in ("digest", "keeper", "ties")}
    key = F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID))
    members = digests.join(groups, "digest", "left_semi").select(F.coalesce("doc_id", F.lit(NO_ID)).alias("key"))
    members = land(members.select(F.xxhash64("key").alias("key")).distinct(), "digest-members")
    known = maybe(members)(F.xxhash64(key))
    lowered = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, LOWER)
    rows = docs.filter(known).withColumn(name["digest"], F.unhex(F.sha2(lowered.cast("binary"), 256)))
    found = groups.select(*[F.col(c).alias(n) for c, n in name.items()])
    joined = rows.join(found, name["digest"], "left")
    stay = joined.filter(F.col(name["keeper"]).isNull() | (F.col(name["keeper"]) == key))
    if not groups.filter("ties > 1").isEmpty():
        stay = stay.withColumn(name["ties"], F.coalesce(name["ties"], F.lit(1)))
        stay = one_of_each(stay, [name["digest"]], name["ties"])
    return docs.filter(~known).select(*docs.columns).unionByName(stay.select(*docs.columns))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays for its text."""
    return deduplicate(documents(spark, sf_dir))


OP2_SQL = """
WITH texts AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       text_sha256
FROM texts
WINDOW same AS (PARTITION BY text_sha256)
"""
