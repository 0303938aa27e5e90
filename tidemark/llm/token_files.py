"""Token-id files with a shared zstandard dictionary.

Every document's ids are compressed on their own with one dictionary, trained
on the ids of a sample, so a short document can be read without its neighbours
and still compresses well. A file set is three Parquet tables, which any store
that Spark writes to can hold:

``dictionary``  ``dictionary_hash`` (SHA-256, hex), ``dictionary``
``segments``    ``segment``, ``chunk``, ``dictionary_hash``, ``first_token`` (ids of
                the segment before the chunk), ``n_docs``, ``n_tokens``,
                ``index``, ``frames`` (binary)
``starts``      ``segment``, ``base`` (ids of all segments before it)

Segments are ascending ranges of doc_id, chunks ascending runs in a segment.
``index`` holds for each document, little-endian: doc_id (int64, the least
value for null), first id within the chunk, number of ids, offset of its frame
in ``frames`` (int64 each). A frame holds the document's ids as unsigned 16-bit
integers while the vocabulary fits them, else 32-bit; ``index`` ends with that
width in bytes as one int64.

Null and empty texts have the end id only. Documents of one doc_id stay in one
segment, in the order of their ids' bytes, so reruns agree. An empty table
gives an empty file set. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import documents, raw_text, slices, sorted_place
from tidemark.llm.tokens import WordEncoder
from tidemark.session import fresh_path

NO_ID = np.iinfo(np.int64).min
SEGMENTS = (
    "segment bigint, chunk bigint, dictionary_hash string, first_token bigint, n_docs bigint, n_tokens bigint, "
    "index binary, frames binary"
)
# Rows of blobs are large: small row groups and pages keep a reader's buffers small.
BLOB_OPTIONS = {
    "parquet.block.size": str(8 * 1024 * 1024),
    "parquet.page.size.row.check.min": "4",
    "parquet.page.size.row.check.max": "16",
    "parquet.enable.dictionary": "false",
}
# Bytes of text in a task's hands at once.
TEXT_BUDGET = 1_000_000


def dictionary_of(samples: list[bytes], size: int) -> bytes:
    """A dictionary of ``size`` bytes at most; empty where samples do not suffice."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def compressor(dictionary: bytes, level: int):
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=level, dict_data=shared, write_content_size=True)


def decompressor(dictionary: bytes):
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdDecompressor(dict_data=shared)


def id_width(path: str) -> str:
    return "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4"


def encoder(path: str, end_id: int, width: str):
    """Tasks: texts to serialized ids."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = WordEncoder(path), np.array([end_id], width).tobytes()
        for batch in batches:
            for begin, texts in slices(batch, "text", TEXT_BUDGET):
                ids = [np.frombuffer(x, "<u4").astype(width).tobytes() + end for x in words.texts(texts)]
                keys = batch.column("doc_id").slice(begin, len(ids))
                yield pa.RecordBatch.from_arrays([keys, pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return encode


def train_dictionary(docs: DataFrame, path: str, width: str, size: int, sample_docs: int, longest: int) -> bytes:
    """Train on about ``sample_docs`` documents of at most ``longest`` bytes of text.

    The sample bounds what the driver holds; long documents are compressed well
    without a dictionary and are left out of it.
    """
    share = min(1.0, sample_docs / max(docs.count(), 1))
    short = docs.sample(share, seed=1).filter(F.octet_length("text") <= longest)
    # A few tasks for the sample, which is bounded: each has to load the tokenizer.
    few = short.repartition(4)
    rows = few.mapInArrow(encoder(path, 0, width), "doc_id bigint, ids binary").select("ids")
    samples = sorted(bytes(row.ids) for row in rows.collect())
    return dictionary_of([s for s in samples if s], size)


def assembler(dictionary_hash: str, width: str, chunk_bytes: int):
    """Tasks: sorted frames to chunks of about ``chunk_bytes``."""
    item = np.dtype(width).itemsize
    names = ["segment", "chunk", "dictionary_hash", "first_token", "n_docs", "n_tokens", "index", "frames"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def packed(segment, chunk, first, keys, counts, frames):
        counts = np.array(counts, np.int64)
        sizes = np.array([len(f) for f in frames], np.int64)
        index = np.concatenate([np.array(keys, np.int64), counts.cumsum() - counts, counts, sizes.cumsum() - sizes])
        blob = index.astype("<i8").tobytes() + np.array([item], "<i8").tobytes()
        row = [segment, chunk, dictionary_hash, first, len(keys), int(counts.sum()), blob, b"".join(frames)]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, chunk, first, held, keys, counts, frames = None, 0, 0, 0, [], [], []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("segment", "doc_id", "n_tokens")]
            stored = (frame.as_py() for frame in batch.column("frame"))
            for at, key, count, frame in zip(*columns, stored):
                if keys and (at != segment or held >= chunk_bytes):
                    yield packed(segment, chunk, first, keys, counts, frames)
                    first += sum(counts)
                    chunk, held, keys, counts, frames = chunk + 1, 0, [], [], []
                if at != segment:
                    segment, chunk, first = at, 0, 0
                keys.append(NO_ID if key is None else key)
                counts.append(count)
                frames.append(frame)
                held += len(frame)
        if keys:
            yield packed(segment, chunk, first, keys, counts, frames)

    return assemble


def write_token_files(
    docs: DataFrame,
    out: str,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    dictionary_bytes: int = 64 * 1024,
    sample_docs: int = 2000,
    sample_text_bytes: int = 16 * 1024,
    level: int = 3,
    docs_per_segment: int = 50_000,
    chunk_bytes: int = 128 * 1024,
) -> str:
    """Write the documents' ids to ``out`` in ascending doc_id; returns ``out``.

    One pass over the texts after the sample: frames, not texts, are shuffled,
    by ranges of doc_id between quantiles. The number of segments follows the
    number of documents.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), raw_text(text_col).alias("text"))
    width = id_width(tokenizer_path)
    dictionary = train_dictionary(rows, tokenizer_path, width, dictionary_bytes, sample_docs, sample_text_bytes)
    dictionary_hash = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(dictionary_hash, dictionary)], "dictionary_hash string, dictionary binary").write.parquet(
        f"{out}/dictionary"
    )

    encode, item = encoder(tokenizer_path, end_id, width), np.dtype(width).itemsize

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write = compressor(dictionary, level).compress
        for batch in encode(batches):
            ids = batch.column("ids").to_pylist()
            counts = pa.array([len(x) // item for x in ids], pa.int64())
            frames = pa.array([write(x) for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), counts, frames], ["doc_id", "n_tokens", "frame"])

    frames = rows.mapInArrow(compress, "doc_id bigint, n_tokens bigint, frame binary")
    n = rows.count()
    segments = max(16, -(-n // docs_per_segment))
    marks = [i / segments for i in range(1, segments)]
    cuts = rows.agg(F.percentile_approx("doc_id", marks, 10 * segments)).first()[0] or []
    placed = frames.withColumn("segment", sorted_place(sorted(set(cuts)), F.col("doc_id")))
    # One task per segment; the sort keeps segments apart where Spark puts several in a task.
    dealt = placed.repartitionById(segments, F.col("segment").cast("int"))
    sorted_frames = dealt.sortWithinPartitions("segment", "doc_id", "frame")
    sorted_frames.select("segment", "doc_id", "n_tokens", "frame").mapInArrow(
        assembler(dictionary_hash, width, chunk_bytes),
        SEGMENTS,
    ).write.options(**BLOB_OPTIONS).parquet(f"{out}/segments")
    totals = spark.read.parquet(f"{out}/segments").groupBy("segment").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select("segment", F.coalesce(before, F.lit(0)).alias("base"))
    starts.write.parquet(f"{out}/starts")
    return out


def opened(index: bytes) -> tuple[np.ndarray, str]:
    """The four index rows of a chunk, and its id width."""
    values = np.frombuffer(index, "<i8")
    return values[:-1].reshape(4, -1), f"<u{values[-1]}"


def read_frame(dictionary: bytes, frames: bytes, index: bytes, position: int) -> np.ndarray:
    """The ids of one document of a chunk; no other frame is touched."""
    (_, _, counts, offsets), width = opened(index)
    end = offsets[position + 1] if position + 1 < len(offsets) else len(frames)
    ids = np.frombuffer(decompressor(dictionary).decompress(frames[offsets[position] : end]), width)
    assert len(ids) == counts[position]
    return ids.astype("<u4")


def load_dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    """The dictionary, checked against its hash."""
    row = spark.read.parquet(f"{path}/dictionary").first()
    dictionary = bytes(row.dictionary)
    if hashlib.sha256(dictionary).hexdigest() != row.dictionary_hash:
        raise ValueError(f"the dictionary of {path} does not match its hash")
    return row.dictionary_hash, dictionary


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a file set: ``doc_id, start, n_tokens, ids``, the last as
    little-endian unsigned 32-bit integers."""
    dictionary_hash, dictionary = load_dictionary(spark, path)
    segments, starts = spark.read.parquet(f"{path}/segments"), spark.read.parquet(f"{path}/starts")
    base = F.col("base") + F.col("first_token")
    rows = segments.join(starts, "segment").select("dictionary_hash", base.alias("base"), "index", "frames")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = decompressor(dictionary).decompress
        for batch in batches:
            for i in range(batch.num_rows):
                used, base, index, frames = (batch.column(c)[i].as_py() for c in range(4))
                if used != dictionary_hash:
                    raise ValueError(f"a chunk needs dictionary {used}, not {dictionary_hash}")
                (keys, starts, counts, offsets), width = opened(index)
                cuts = [*offsets.tolist(), len(frames)]
                ids = [np.frombuffer(read(frames[a:b]), width).astype("<u4").tobytes() for a, b in zip(cuts, cuts[1:])]
                if [len(x) // 4 for x in ids] != counts.tolist():
                    raise ValueError("a frame does not hold the ids its index states")
                named = pa.array(keys, pa.int64(), mask=keys == NO_ID)
                yield pa.RecordBatch.from_arrays(
                    [named, pa.array(starts + base), pa.array(counts), pa.array(ids, pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return rows.mapInArrow(decode, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents' ids and read them back."""
    out = fresh_path(spark, "token-files")
    write_token_files(documents(spark, sf_dir), out, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, out).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
