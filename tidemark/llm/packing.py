"""Cost-balanced packing of token sequences.

A piece of n tokens costs ``linear * n + quadratic * n * n``: attention stays
within a document. Documents are packed in runs of neighbouring documents of a
task. In a run, whole windows of long documents become sequences of their own;
the rest is assigned in descending cost to the sequence of lowest cost among
those with room. Documents that fit nowhere whole are cut over the remaining
room. What is left over at the end of a run, less than one window, becomes
sequences whose lengths are powers of two, which need no padding; so no
sequence is padded at all.

Null and empty texts consist of the end id only. Rows that repeat a doc_id are
packed as separate documents. An empty table gives no pieces. Extra columns are
not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import documents, raw_text, slices
from tidemark.llm.tokens import WordEncoder

TEXT_BUDGET = 1_000_000
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def balanced(lengths: list[int], window: int, linear: float, quadratic: float) -> list[list[tuple[int, int, int]]]:
    """Sequences of ``(document, start, length)`` that hold every token once.

    All sequences are ``window`` long but for at most log2(window) at the end,
    whose lengths are distinct powers of two.
    """

    def cost(n: int) -> float:
        return linear * n + quadratic * n * n

    full, rest = [], []
    for doc, n in enumerate(lengths):
        whole = n - n % window
        full += [[(doc, at, window)] for at in range(0, whole, window)]
        if n > whole:
            rest.append((n - whole, doc, whole))
    open_count = sum(n for n, _, _ in rest) // window
    members: list[list[tuple[int, int, int]]] = [[] for _ in range(open_count)]
    room = [window] * open_count
    heap = [(0.0, s) for s in range(open_count)]
    waiting = []
    for n, doc, at in sorted(rest, key=lambda x: (-x[0], x[1])):
        passed = []
        while heap and room[heap[0][1]] < n:
            passed.append(heapq.heappop(heap))
        if heap:
            spent, s = heapq.heappop(heap)
            members[s].append((doc, at, n))
            room[s] -= n
            if room[s]:
                heapq.heappush(heap, (spent + cost(n), s))
        else:
            waiting.append((n, doc, at))
        for entry in passed:
            heapq.heappush(heap, entry)
    open_rooms = sorted((s for s in range(open_count) if room[s]), key=lambda s: -room[s])
    last: list[tuple[int, int, int]] = []
    for n, doc, at in waiting:
        while n and open_rooms:
            s = open_rooms[-1]
            take = min(n, room[s])
            members[s].append((doc, at, take))
            room[s] -= take
            n, at = n - take, at + take
            if not room[s]:
                open_rooms.pop()
        if n:
            last.append((doc, at, n))
    return full + members + powers(last)


def powers(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """Cut pieces of less than a window in all into sequences of the powers of two that sum to them."""
    total = sum(n for _, _, n in pieces)
    sizes = [1 << b for b in reversed(range(total.bit_length())) if total >> b & 1]
    out, queue = [], list(reversed(pieces))
    for size in sizes:
        sequence = []
        while size:
            doc, at, n = queue.pop()
            take = min(n, size)
            sequence.append((doc, at, take))
            size -= take
            if n > take:
                queue.append((doc, at + take, n - take))
        out.append(sequence)
    return out


def packer(path: str, end_id: int, window: int, linear: float, quadratic: float, run_tokens: int, most_words: int):
    def packed(keys: list, ids: list[bytes], first: int) -> tuple[pa.RecordBatch, int]:
        lengths = [len(x) // 4 for x in ids]
        sequences = balanced(lengths, window, linear, quadratic)
        rows = []
        for number, sequence in enumerate(sequences, first):
            offset = 0
            for doc, at, n in sequence:
                crc = zlib.crc32(memoryview(ids[doc])[4 * at : 4 * (at + n)])
                rows.append((keys[doc], at, n, crc, lengths[doc], number, offset))
                offset += n
        columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
        names = [c.split()[0] for c in PIECES.split(", ")]
        return pa.RecordBatch.from_arrays(columns, names), first + len(sequences)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = WordEncoder(path, most_words), np.array([end_id], "<u4").tobytes()
        # A task numbers its own sequences; the scan's partitions are the same on a retry.
        number, keys, ids, held = TaskContext.get().partitionId() << 40, [], [], 0
        for batch in batches:
            for begin, texts in slices(batch, "text", TEXT_BUDGET):
                for key, x in zip(batch.column("doc_id").slice(begin, len(texts)).to_pylist(), words.texts(texts)):
                    keys.append(key)
                    ids.append(x + end)
                    held += len(x) // 4 + 1
                    if held >= run_tokens:
                        out, number = packed(keys, ids, number)
                        yield out
                        keys, ids, held = [], [], 0
        if keys:
            yield packed(keys, ids, number)[0]

    return pack


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    window: int = 4096,
    linear: float = 1.0,
    quadratic: float = 1.0 / 4096,
    run_tokens: int = 2_000_000,
    most_words: int = 400_000,
) -> DataFrame:
    """Pieces of all documents with their sequence and place in it. No shuffle.

    ``run_tokens`` bounds the ids that a task holds, but for one long document,
    and ``most_words`` the pieces of text that its encoder remembers.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), raw_text(text_col).alias("text"))
    return rows.mapInArrow(packer(tokenizer_path, end_id, window, linear, quadratic, run_tokens, most_words), PIECES)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
