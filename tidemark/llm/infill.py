"""Fill-in-the-middle by secondary sort.

A text is cut into units: runs of letters A-Z, and all other code points one by
one. Two numbers drawn from the SHA-256 of the seed and doc_id cut the units
into prefix, middle and suffix; two more choose the form: ``plain`` (the text as
it is), ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle).
Each part is led by its mark.

The texts become pieces of whole units of at most ``CHUNK`` bytes (a longer
unit stays whole), each with its document and its position in the output. The
pieces are dealt by document and sorted by position within the partitions, as
``repartitionAndSortWithinPartitions`` does, and stream into incremental
digests, so that no task holds a whole output. To restore a text, its output is
read as a stream, split at the marks, and its pieces are sorted once more, in
the same partition, by the order of the parts.

Null texts count as empty. Empty texts, and texts that hold a mark, are plain
and cut nowhere. A null doc_id is drawn for as if it were written as nothing.
Rows that repeat a doc_id are documents of their own, with the same draws. An
empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import documents, raw_text, slices

MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
RESTORED = ("prefix", "middle", "suffix")
SEED, PLAIN_PERCENT, SPM_PERCENT = 1, 10, 20

CHUNK = 8 * 1024
BLOCK = 1 << 20
BATCH_BYTES = 4 << 20
# 0: a code point that is a unit of its own begins here, 1: a letter, 2: a byte inside a code point.
LETTER, INSIDE = 1, 2
KINDS = np.zeros(256, np.uint8)
KINDS[ord("A") : ord("Z") + 1] = LETTER
KINDS[ord("a") : ord("z") + 1] = LETTER
KINDS[0x80:0xC0] = INSIDE

# Position -1 is a document's head: it holds what is told of it, and no bytes.
TOLD = "n bigint, form string, prefix_chars bigint, middle_chars bigint"
PIECES = f"row bigint, doc_id bigint, position bigint, piece binary, {TOLD}"
SORTED_PARTS = f"row bigint, doc_id bigint, part int, position bigint, piece binary, {TOLD}, output_sha256 string"
DIGESTS = f"doc_id bigint, {TOLD}, output_sha256 string, restored_sha256 string"
OUTPUTS = f"doc_id bigint, {TOLD}, output string"


def names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def unit_starts(data: np.ndarray, begin: int, end: int) -> np.ndarray:
    """Places in ``begin..end`` at which a unit starts."""
    kinds = KINDS[data[begin:end]]
    after_letter = np.empty(len(kinds), bool)
    after_letter[1:] = kinds[:-1] == LETTER
    after_letter[:1] = begin > 0 and KINDS[data[begin - 1]] == LETTER
    return begin + np.flatnonzero((kinds == 0) | ((kinds == LETTER) & ~after_letter))


def characters(data: np.ndarray, begin: int, end: int) -> int:
    return sum(int(np.count_nonzero(KINDS[data[at : min(at + BLOCK, end)]] != INSIDE)) for at in range(begin, end, BLOCK))


class Units:
    """The units of one text, counted in blocks so that memory does not grow with their number."""

    def __init__(self, text: bytes):
        self.data = np.frombuffer(text, np.uint8)
        self.blocks = range(0, len(text), BLOCK)
        self.counts = [len(self.in_block(at)) for at in self.blocks]
        self.total = sum(self.counts)

    def in_block(self, at: int) -> np.ndarray:
        return unit_starts(self.data, at, min(at + BLOCK, len(self.data)))

    def place(self, unit: int) -> int:
        """The byte at which a unit starts; the text's length for the one after the last."""
        for at, count in zip(self.blocks, self.counts):
            if unit < count:
                return int(self.in_block(at)[unit])
            unit -= count
        return len(self.data)


def chunks(data: np.ndarray, begin: int, end: int, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole units of at most ``most`` bytes, or of one longer unit."""
    while end - begin > most:
        inside = unit_starts(data, begin + 1, begin + most + 1)
        cut = int(inside[-1]) if len(inside) else None
        ahead = begin + most + 1
        while cut is None and ahead < end:
            beyond = unit_starts(data, ahead, min(ahead + BLOCK, end))
            cut, ahead = (int(beyond[0]) if len(beyond) else None), ahead + BLOCK
        if cut is None or cut >= end:
            break
        yield begin, cut
        begin = cut
    yield begin, end


@dataclass(frozen=True)
class Layout:
    """How the documents are drawn for."""

    seed: int = SEED
    plain_percent: int = PLAIN_PERCENT
    spm_percent: int = SPM_PERCENT

    def draws(self, key: int | None) -> list[int]:
        digest = hashlib.sha256(f"{self.seed}:{'' if key is None else key}".encode()).digest()
        return np.frombuffer(digest[:16], ">u4").tolist()

    def form(self, text: bytes, draws: list[int]) -> str:
        if not text or any(mark in text for mark in MARKS.values()) or draws[2] % 100 >= 100 - self.plain_percent:
            return "plain"
        return "spm" if draws[3] % 100 < self.spm_percent else "psm"

    def pieces(self, key: int | None, text: bytes, most: int) -> tuple[tuple, list[bytes]]:
        """What is told of a document, and the pieces of its output in their order."""
        units, draws = Units(text), self.draws(key)
        data, form = units.data, self.form(text, draws)
        if form == "plain":
            spans = list(chunks(data, 0, len(text), most))
            return (units.total, form, None, None), [text[a:b] for a, b in spans if a < b]
        low, high = sorted(draw % (units.total + 1) for draw in draws[:2])
        a, b = units.place(low), units.place(high)
        spans = {"prefix": (0, a), "middle": (a, b), "suffix": (b, len(text))}
        out = []
        for part in ORDERS[form]:
            first, *rest = [text[i:j] for i, j in chunks(data, *spans[part], most)]
            out += [MARKS[part] + first, *rest]
        return (units.total, form, characters(data, 0, a), characters(data, a, b)), out


def split_marks(pieces: Iterable[bytes], form: str) -> Iterator[tuple[int, bytes]]:
    """An output's stream as ``(part, bytes)``, the part by its place in the text."""
    if form == "plain":
        yield from ((0, piece) for piece in pieces)
        return
    ahead, part, held = list(ORDERS[form]), None, b""
    for piece in pieces:
        held += piece
        while ahead and (at := held.find(MARKS[ahead[0]])) >= 0:
            if at:
                yield RESTORED.index(part), held[:at]
            part = ahead.pop(0)
            held = held[at + len(MARKS[part]) :]
        keep = 2 if ahead else 0  # bytes that may begin a mark
        if len(held) > keep:
            yield RESTORED.index(part), held[: len(held) - keep]
            held = held[len(held) - keep :]
    if held:
        yield RESTORED.index(part), held


def batches_of(rows: Iterable[tuple], schema: str, payload: int | None = None) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded bytes; ``payload`` is the place of the bytes in a row."""
    types = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    kinds = [types[field.split()[1]] for field in schema.split(", ")]

    def batch(held: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(values, kind) for values, kind in zip(zip(*held), kinds)]
        return pa.RecordBatch.from_arrays(columns, names(schema))

    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + (len(row[payload] or b"") if payload is not None else 0)
        if size >= BATCH_BYTES:
            yield batch(held)
            held, size = [], 0
    if held:
        yield batch(held)


def cutter(layout: Layout, chunk: int):
    """Tasks: documents to pieces."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        # A task numbers its own documents; the scan's partitions are the same on a retry.
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for begin, texts in slices(batch, "text", BATCH_BYTES):
                keys = batch.column("doc_id").slice(begin, len(texts)).to_pylist()
                for key, text in zip(keys, texts):
                    told, pieces = layout.pieces(key, text, chunk)
                    yield row, key, -1, None, *told
                    for position, piece in enumerate(pieces):
                        yield row, key, position, piece, None, None, None, None
                    row += 1

    return lambda batches: batches_of(rows(batches), PIECES, payload=3)


def grouped(batches: Iterator[pa.RecordBatch], schema: str) -> Iterator[tuple[dict, Iterator[dict]]]:
    """A sorted stream as documents: the head's row, and an iterator of the rows behind it."""
    columns = names(schema)

    def stream() -> Iterator[dict]:
        for batch in batches:
            for values in zip(*(batch.column(c).to_pylist() for c in columns)):
                yield dict(zip(columns, values))

    rows = stream()
    ahead = next(rows, None)

    def behind(row: int) -> Iterator[dict]:
        nonlocal ahead
        ahead = next(rows, None)
        while ahead is not None and ahead["row"] == row:
            yield ahead
            ahead = next(rows, None)

    while ahead is not None:
        head = ahead
        rest = behind(head["row"])
        yield head, rest
        for _ in rest:
            pass


def told_of(head: dict) -> tuple:
    return tuple(head[c] for c in names(TOLD))


def digest_outputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tasks: pieces in output order to digests of the outputs, and the pieces with their part."""

    def rows() -> Iterator[tuple]:
        for head, rest in grouped(batches, PIECES):
            row, key, digest = head["row"], head["doc_id"], hashlib.sha256()

            def read() -> Iterator[bytes]:
                for piece in rest:
                    digest.update(piece["piece"])
                    yield piece["piece"]

            for position, (part, data) in enumerate(split_marks(read(), head["form"])):
                yield row, key, part, position, data, None, None, None, None, None
            yield row, key, -1, -1, None, *told_of(head), digest.hexdigest()

    return batches_of(rows(), SORTED_PARTS, payload=4)


def digest_restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tasks: pieces in the order of the text to a row per document."""

    def rows() -> Iterator[tuple]:
        for head, rest in grouped(batches, SORTED_PARTS):
            digest = hashlib.sha256()
            for piece in rest:
                digest.update(piece["piece"])
            yield head["doc_id"], *told_of(head), head["output_sha256"], digest.hexdigest()

    return batches_of(rows(), DIGESTS)


def join_outputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tasks: pieces in output order to a row per document with its whole output."""

    def rows() -> Iterator[tuple]:
        for head, rest in grouped(batches, PIECES):
            output = b"".join(piece["piece"] for piece in rest)
            yield head["doc_id"], *told_of(head), output.decode()

    return batches_of(rows(), OUTPUTS, payload=5)


def output_pieces(
    docs: DataFrame, layout: Layout = Layout(), *, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK
) -> DataFrame:
    """All pieces of a document in one partition, in output order, behind its head (position -1).

    ``docs`` must give the same partitions when read again, as a table does.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), raw_text(text_col).alias("text"))
    return rows.mapInArrow(cutter(layout, chunk), PIECES).repartition("row").sortWithinPartitions("row", "position")


def output_texts(pieces: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of pieces in output order."""
    return pieces.mapInArrow(join_outputs, OUTPUTS)


def digests(pieces: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` of pieces in output order.

    The restored text is what the output and the form alone give.
    """
    parts = pieces.mapInArrow(digest_outputs, SORTED_PARTS)
    return parts.sortWithinPartitions("row", "part", "position").mapInArrow(digest_restored, DIGESTS)


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms, cuts and digests of all documents."""
    return digests(output_pieces(documents(spark, sf_dir)))


OP13_SQL = f"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), drawn AS (
  SELECT *, len(units) AS n,
         [CAST('0x' || h[8 * i + 1 : 8 * i + 8] AS BIGINT) FOR i IN range(4)] AS d
  FROM cut
), formed AS (
  SELECT *, least(d[1] % (n + 1), d[2] % (n + 1)) AS low, greatest(d[1] % (n + 1), d[2] % (n + 1)) AS high,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR d[3] % 100 >= {100 - PLAIN_PERCENT} THEN 'plain'
              WHEN d[4] % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, array_to_string(units[1 : low], '') AS prefix, array_to_string(units[low + 1 : high], '') AS middle,
         array_to_string(units[high + 1 : n], '') AS suffix
  FROM formed
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
              WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
