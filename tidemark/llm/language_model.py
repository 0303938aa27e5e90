"""A bigram model in a log-frequency Bloom filter, and scores of whole texts.

Counts are gathered over all training documents: tasks count the n-grams of
runs of documents and send sorted keys by bucket, reducers add them up. The
filter holds, for an n-gram of quantised count q, the entries (n-gram, lowest
level) to (n-gram, q); its count is read back by probing level after level
until one is missing. Every bucket owns a slice of the filter. The slices hold
all n-grams and are nowhere put together: the most frequent words and pairs, up
to a bound, are broadcast with their levels, and for all others the slices are
asked by bucket. Questions on words come first; their levels go on with the
questions on pairs.

The probability of a word after another is interpolated: a share, which depends
on the level of the first word and is fitted by leaving one out, times the
bigram estimate, and the rest times the add-one unigram estimate, both from
probed counts. So a text's score follows from how many of its tokens have which
levels (of the word before, of its own, of both), the text's cells. The base
score uses exact counts in the same way.

A-Z are lower-cased, tokens are words ``[^\\x20\\x09-\\x0D]+`` and one end per
text; null and empty texts have the end only. The end of one text stands before
the first word of the next of a run of texts. Keys are 64-bit hashes of the
words. Without training documents all counts are zero. An empty table gives no
rows; rows of one doc_id are scored each; extra columns are not read.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import documents, land, raw_text, remainder, slices
from tidemark.session import fresh_path

END = b"\n"  # no word holds white space
UNIGRAM, BIGRAM = 0, 1
# The ratio between count levels, and levels enough for any 64-bit count.
RATIO, LEVELS = 1.5, 110
HASHES = 4
TEXT_BUDGET = 1_000_000
COUNTS = "kind int, bucket bigint, keys binary, counts binary"
TOTALS = COUNTS + ", held array<bigint>, tokens bigint, types bigint"


class WordKeys(dict):
    """64-bit hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        key = self[word] = xxhash.xxh64_intdigest(word)
        return key


def token_keys(known: WordKeys, texts: list[bytes], most: int = 200_000) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all tokens, one text's after another's, and the number of each text's."""
    if len(known) > most:
        known.clear()
    parts, counts = [], np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = text.lower().split()
        words.append(END)
        counts[i] = len(words)
        parts.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
    return np.concatenate(parts), counts


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit hash; every bit depends on all."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def pair_keys(before: np.ndarray, own: np.ndarray) -> np.ndarray:
    return mixed_bits(before * np.uint64(0x9E3779B97F4A7C15) + own)


def bigram_keys(keys: np.ndarray) -> np.ndarray:
    """Key of each token with the one before it; before the first stands an end."""
    before = np.empty_like(keys)
    before[1:] = keys[:-1]
    before[:1] = xxhash.xxh64_intdigest(END)
    return pair_keys(before, keys)


def level_of(counts: np.ndarray) -> np.ndarray:
    """Quantised counts: 1 for a count of 1, and one more for each factor of RATIO."""
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / math.log(RATIO) + 1e-9).astype(np.int64)


# The middle of the counts of a level, 0 for none.
LEVEL_COUNT = np.array([0.0] + [(math.ceil(RATIO**q - 1e-6) + math.ceil(RATIO ** (q + 1) - 1e-6) - 1) / 2 for q in range(LEVELS)])


def bucket_bounds(keys: np.ndarray, bits: int) -> list[int]:
    """Where each bucket (the leading bits) begins in sorted keys, and the end."""
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return [0, *np.searchsorted(keys, edges).tolist(), len(keys)]


def packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def unpacked(data, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def packed_sorted(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, their bytes plane by plane: the leading planes are nearly all zero."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return packed(np.ascontiguousarray(steps.astype("<u8").view(np.uint8).reshape(-1, 8).T))


def unpacked_sorted(data) -> np.ndarray:
    planes = unpacked(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def count_rows(kind: int, keys: np.ndarray, counts: np.ndarray, bits: int) -> pa.RecordBatch:
    cuts = bucket_bounds(keys, bits)
    spans = [(b, x, y) for b, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
    columns = [
        pa.array([kind] * len(spans), pa.int32()),
        pa.array([b for b, _, _ in spans], pa.int64()),
        pa.array([packed_sorted(keys[x:y]) for _, x, y in spans], pa.binary()),
        pa.array([packed(counts[x:y].astype(np.uint32)) for _, x, y in spans], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["kind", "bucket", "keys", "counts"])


def counter(bits: int, tokens_at_once: int):
    """Tasks: texts to counts of their n-grams, added up over runs of texts."""

    def flush(runs: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for kind, keys in ((UNIGRAM, runs), (BIGRAM, [bigram_keys(r) for r in runs])):
            yield count_rows(kind, *np.unique(np.concatenate(keys), return_counts=True), bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, runs, held = WordKeys(), [], 0
        for batch in batches:
            for _, texts in slices(batch, "text", TEXT_BUDGET):
                runs.append(token_keys(known, texts)[0])
                held += len(runs[-1])
                if held >= tokens_at_once:
                    yield from flush(runs)
                    runs, held = [], 0
        if runs:
            yield from flush(runs)

    return count


def totaler(least: tuple[int, int]):
    def total(group: pa.Table) -> pa.Table:
        """Add up one bucket; n-grams below ``least`` of their kind count, but are not kept."""
        kind, bucket = group.column("kind")[0].as_py(), group.column("bucket")[0].as_py()
        keys = np.concatenate([unpacked_sorted(x.as_buffer()) for x in group.column("keys")])
        counts = np.concatenate([unpacked(x.as_buffer(), np.uint32) for x in group.column("counts")])
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, counts = keys[first], np.add.reduceat(counts, first)
        tokens, types = int(counts.sum()), len(keys)
        stay = counts >= least[kind]
        keys, counts = keys[stay], counts[stay]
        held = np.bincount(level_of(counts), minlength=LEVELS).tolist()
        row = [kind, bucket, keys.tobytes(), counts.tobytes(), held, tokens, types]
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64()]
        names = [c.split()[0] for c in TOTALS.split(", ")]
        return pa.Table.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

    return total


def positions(keys: np.ndarray, level: int, probe: int) -> np.ndarray:
    """A hash of (n-gram, level, probe)."""
    salt = (0x9E3779B97F4A7C15 * level + 0xD6E8FEB86659FD93 * probe) % (1 << 64)
    return mixed_bits(keys + np.uint64(salt))


def filter_slice(keys: np.ndarray, levels: np.ndarray, lowest: int, bits_per_entry: int) -> bytes:
    """The bits of n-grams of these levels."""
    entries = int(np.maximum(levels - lowest + 1, 0).sum())
    size = max(64, -(-entries * bits_per_entry // 64) * 64)
    bits = np.zeros(size, bool)
    for level in range(lowest, int(levels.max(initial=0)) + 1):
        there = keys[levels >= level]
        for probe in range(HASHES):
            bits[positions(there, level, probe) % np.uint64(size)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def probed_levels(data: np.ndarray, start, size, keys: np.ndarray, lowest: int) -> np.ndarray:
    """Level of each n-gram by repeated probes of its slice of the bits, 0 where the first is missing."""
    out = np.zeros(len(keys), np.int64)
    start, size = np.broadcast_to(start, len(keys)), np.broadcast_to(size, len(keys))
    live, level = np.flatnonzero(size), lowest
    while len(live):
        for probe in range(HASHES):
            place = start[live] + (positions(keys[live], level, probe) % size[live]).astype(np.int64)
            live = live[(data[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1]
        out[live] = level
        level += 1
    return out


def estimates(before: np.ndarray, own: np.ndarray, both: np.ndarray, size: int, less: float = 0.0):
    """Bigram and unigram probabilities by levels; ``less`` is taken off all counts to leave a token out."""
    context = np.maximum(LEVEL_COUNT[before] - less, 0)
    pair = np.minimum(np.maximum(LEVEL_COUNT[both] - less, 0), context)
    after = np.divide(pair, context, out=np.zeros(len(pair)), where=context > 0)
    return after, (np.maximum(LEVEL_COUNT[own] - less, 0) + 1) / size


# A cell is the levels of the word before, of the word and of both in seven bits each, and whether the text is learnt from.
LEARNT = 1 << 21


def cell_levels(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    cells = cells.astype(np.int64)
    return cells >> 14 & 127, cells >> 7 & 127, cells & 127


def fit_shares(cells: np.ndarray, n: np.ndarray, size: int, rounds: int = 20) -> np.ndarray:
    """Expectation-maximisation over the cells of texts, each token left out of the counts."""
    before, own, both = cell_levels(cells)
    after, alone = estimates(before, own, both, size, less=1.0)
    shares, total = np.full(LEVELS, 0.5), np.bincount(before, weights=n, minlength=LEVELS)
    for _ in range(rounds):
        pair = shares[before] * after
        due = np.bincount(before, weights=n * pair / (pair + (1 - shares[before]) * alone), minlength=LEVELS)
        shares = due / (total + 1)  # one more, so that a level seen once does not trust itself
    return np.minimum(shares, 0.999) * (np.arange(LEVELS) > 0)


def cell_scores(cells: np.ndarray, shares: np.ndarray, size: int) -> np.ndarray:
    before, own, both = cell_levels(cells)
    after, alone = estimates(before, own, both, size)
    return np.log10(shares[before] * after + (1 - shares[before]) * alone)


def level_totals(counts: DataFrame) -> np.ndarray:
    """How many n-grams of each kind have each level."""
    by_level = counts.select("kind", F.posexplode("held").alias("level", "n")).groupBy("kind", "level").agg(F.sum("n").alias("n"))
    held = np.zeros((2, LEVELS), np.int64)
    for row in by_level.collect():
        held[row.kind, row.level] = row.n
    return held


def frequent_from(held: np.ndarray, most: int) -> int:
    """The lowest level whose n-grams, with those above, are ``most`` at most."""
    level = LEVELS
    while level > 1 and held[level - 1] <= most:
        level -= 1
        most -= held[level]
    return level


SLICES = (
    "kind int, bucket bigint, keys binary, counts binary, held array<bigint>, tokens bigint, types bigint, "
    "slice binary, top_keys binary, top_counts binary, top_levels binary, told_levels binary"
)


def slice_totaler(least: tuple[int, int], most: tuple[int, int], bits_per_entry: int):
    """Add up one bucket and make its slice; counts are kept of words, and ``most`` frequent n-grams beside them.

    The frequent ones come with their level and the level that the slice tells.
    """
    total, lowest = totaler(least), [int(level_of(np.array([n]))[0]) for n in least]
    names = [c.split()[0] for c in SLICES.split(", ")]

    def build(group: pa.Table) -> pa.Table:
        row = total(group).to_pylist()[0]
        kind, keys, counts = row["kind"], np.frombuffer(row["keys"], np.uint64), np.frombuffer(row["counts"], np.int64)
        levels = level_of(counts)
        bits = filter_slice(keys, levels, lowest[kind], bits_per_entry)
        top = levels >= frequent_from(np.bincount(levels, minlength=LEVELS), most[kind])
        told = probed_levels(np.frombuffer(bits, np.uint8), 0, np.uint64(8 * len(bits)), keys[top], lowest[kind])
        if kind == BIGRAM:
            row |= {"keys": b"", "counts": b""}
        row |= {"slice": bits, "top_keys": keys[top].tobytes(), "top_counts": counts[top].tobytes()}
        row |= {"top_levels": levels[top].astype(np.uint8).tobytes(), "told_levels": told.astype(np.uint8).tobytes()}
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64(), *[pa.binary()] * 5]
        return pa.Table.from_arrays([pa.array([row[c]], k) for c, k in zip(names, kinds)], names)

    return build


@dataclass
class Model:
    """What is broadcast: sorted keys of the most frequent words and pairs, their counts and levels."""

    tokens: int
    types: int
    keys: tuple[np.ndarray, np.ndarray]  # by kind
    counts: np.ndarray  # of the words
    levels: tuple[np.ndarray, np.ndarray]

    def parts(self) -> tuple:
        """Plain arrays and numbers, which a worker can read without this package."""
        return tuple(vars(self).values())

    def find(self, keys: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of the n-grams are here, and where."""
        held = self.keys[kind]
        if not len(held):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        place = np.minimum(np.searchsorted(held, keys), len(held) - 1)
        return held[place] == keys, place


def frequent(sliced: DataFrame, kind: int, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys, counts and told levels of the n-grams of ``level`` and above."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                stay = np.frombuffer(batch.column("top_levels")[i].as_buffer(), np.uint8) >= level
                columns = [
                    np.frombuffer(batch.column(c)[i].as_buffer(), t)[stay].tobytes()
                    for c, t in (("top_keys", np.uint64), ("top_counts", np.int64), ("told_levels", np.uint8))
                ]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in columns], ["keys", "counts", "levels"])

    rows = sliced.filter(F.col("kind") == kind).select("top_keys", "top_counts", "top_levels", "told_levels")
    found = rows.mapInArrow(pick, "keys binary, counts binary, levels binary").collect()
    columns = [np.frombuffer(b"".join(bytes(r[k]) for r in found), t) for k, t in enumerate((np.uint64, np.int64, np.uint8))]
    order = np.argsort(columns[0])
    keys, counts, levels = (c[order] for c in columns)
    return keys, counts, levels


def train(
    docs: DataFrame,
    bits: int,
    *,
    least: tuple[int, int] = (1, 1),
    bits_per_entry: int = 10,
    most_words: int = 1 << 18,
    most_pairs: int = 1 << 20,
    tokens_at_once: int = 2_000_000,
) -> tuple[Model, DataFrame]:
    """A model of ``text`` rows, and the slices of its filter.

    ``least`` are the smallest counts kept of words and pairs; ``most_words``
    and ``most_pairs`` bound what is broadcast.
    """
    partial = docs.select("text").mapInArrow(counter(bits, tokens_at_once), COUNTS)
    # Buckets are even, being of hashes: twice its part holds a bucket's frequent n-grams. Others would be asked for.
    most = tuple(2 * n // (1 << bits) + 1000 for n in (most_words, most_pairs))
    build = slice_totaler((1, least[BIGRAM]), most, bits_per_entry)
    sliced = land(partial.groupBy("kind", "bucket").applyInArrow(build, SLICES), "ngram-slices")
    words = sliced.filter(F.col("kind") == UNIGRAM).agg(F.sum("tokens"), F.sum("types")).first()
    held = level_totals(sliced)
    (word_keys, word_counts, word_levels), (pair_keys, _, pair_levels) = (
        frequent(sliced, k, frequent_from(held[k], n)) for k, n in ((UNIGRAM, most_words), (BIGRAM, most_pairs))
    )
    return Model(words[0] or 0, words[1] or 0, (word_keys, pair_keys), word_counts, (word_levels, pair_levels)), sliced


# A row is a document (row is not null), a chunk's tokens with words to ask for (tokens), or questions to one
# bucket; ``kind`` is of the questions. Cells of a row's documents are in ``rows, cells, n``.
SCORED = (
    "chunk bigint, row int, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, "
    "kind int, bucket bigint, keys binary, rows binary, cells binary, n binary, tokens binary"
)
SCORED_NAMES = [c.split()[0] for c in SCORED.split(", ")]
SCORED_KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int64()]
SCORED_KINDS += [pa.binary()] * 5
# A token of which a word is to be asked for: levels that are known, 255 for unknown.
TOKEN = np.dtype([("own", np.uint64), ("before", np.uint64), ("row", np.int32), ("learnt", np.uint8)]
                 + [(f"{c}_level", np.uint8) for c in ("own", "before", "both")])
UNKNOWN = 255


def scored_rows(columns: dict, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in zip(SCORED_NAMES, SCORED_KINDS)], SCORED_NAMES
    )


def cell_columns(rows: np.ndarray, cells: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Cells of tokens, counted for each document of a chunk."""
    both, n = np.unique(rows.astype(np.uint64) << np.uint64(32) | cells.astype(np.uint64), return_counts=True)
    return packed((both >> np.uint64(32)).astype(np.int32)), packed(both.astype(np.uint32)), packed(n.astype(np.uint32))


def questions(chunk: int, kind: int, bits: int, keys: np.ndarray, **more: np.ndarray) -> pa.RecordBatch:
    """The n-grams to ask for, by bucket, with what must come back beside them."""
    # In the order of the texts within a bucket: what comes back then packs well.
    order = np.argsort((keys >> np.uint64(64 - bits)).astype(np.uint32), kind="stable")
    keys, more = keys[order], {c: v[order] for c, v in more.items()}
    cuts = bucket_bounds(keys, bits)
    spans = [(b, x, y) for b, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
    columns = {"chunk": [chunk] * len(spans), "kind": [kind] * len(spans), "bucket": [b for b, _, _ in spans]}
    columns["keys"] = [keys[x:y].tobytes() for _, x, y in spans]
    columns |= {c: [packed(v[x:y]) for _, x, y in spans] for c, v in more.items()}
    return scored_rows(columns, len(spans))


def sorted_out(chunk: int, bits: int, tokens: np.ndarray) -> list[pa.RecordBatch]:
    """Tokens whose words are known: cells, and questions on pairs."""
    cells = tokens["learnt"].astype(np.uint32) * np.uint32(LEARNT)
    cells |= tokens["before_level"].astype(np.uint32) << np.uint32(14) | tokens["own_level"].astype(np.uint32) << np.uint32(7)
    told, out = tokens["both_level"] != UNKNOWN, []
    if told.any():
        columns = cell_columns(tokens["row"][told], cells[told] | tokens["both_level"][told])
        out.append(scored_rows({"chunk": [chunk]} | {c: [v] for c, v in zip(("rows", "cells", "n"), columns)}, 1))
    if not told.all():
        rest = tokens[~told]
        both = pair_keys(rest["before"], rest["own"])
        out.append(questions(chunk, BIGRAM, bits, both, rows=rest["row"], cells=cells[~told]))
    return out


def scorer(shared, bits: int, docs_at_once: int, asked_at_once: int):
    """Tasks: texts to documents, cells, and questions on rarer words and pairs by bucket."""
    end = np.uint64(xxhash.xxh64_intdigest(END))

    def flush(chunk: int, parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        tokens = np.concatenate(parts)
        waits = (tokens["own_level"] == UNKNOWN) | (tokens["before_level"] == UNKNOWN)
        yield from sorted_out(chunk, bits, tokens[~waits])
        if waits.any():
            asked = tokens[waits]
            words = [asked[c][asked[f"{c}_level"] == UNKNOWN] for c in ("own", "before")]
            yield questions(chunk, UNIGRAM, bits, np.unique(np.concatenate(words)))
            yield scored_rows({"chunk": [chunk], "tokens": [packed(asked)]}, 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = Model(*shared.value), WordKeys()
        chunk, row, held, parts = TaskContext.get().partitionId() << 32, 0, 0, []
        for batch in batches:
            for begin, texts in slices(batch, "text", TEXT_BUDGET):
                keys, counts = token_keys(known, texts)
                starts, n = counts.cumsum() - counts, len(texts)
                part = batch.slice(begin, n)
                tokens = np.empty(len(keys), TOKEN)
                tokens["own"] = keys
                tokens["before"][1:], tokens["before"][:1] = keys[:-1], end
                tokens["row"] = np.repeat(np.arange(row, row + n), counts)
                tokens["learnt"] = np.repeat(part.column("learnt").to_numpy(zero_copy_only=False), counts)
                common, place = model.find(keys, UNIGRAM)
                levels = np.full(len(keys), UNKNOWN, np.uint8)
                levels[common] = model.levels[UNIGRAM][place[common]]
                exact = np.zeros(len(keys))
                exact[common] = np.log10(model.counts[place[common]] + 1)
                tokens["own_level"], tokens["before_level"][1:] = levels, levels[:-1]
                there, at = model.find(np.array([end]), UNIGRAM)
                tokens["before_level"][:1] = model.levels[UNIGRAM][at[0]] if there[0] else UNKNOWN
                there, at = model.find(bigram_keys(keys), BIGRAM)
                tokens["both_level"] = UNKNOWN
                tokens["both_level"][there] = model.levels[BIGRAM][at[there]]
                columns = {
                    "chunk": [chunk] * n,
                    "row": np.arange(row, row + n, dtype=np.int32),
                    "doc_id": part.column("doc_id").to_pylist(),
                    "held_out": part.column("held_out").to_pylist(),
                    "n_tokens": counts,
                    "known": np.add.reduceat(common, starts, dtype=np.int64),
                    "base": np.add.reduceat(exact, starts) - counts * math.log10(model.tokens + model.types + 1),
                }
                yield scored_rows(columns, n)
                parts.append(tokens)
                held += len(tokens)
                row += n
                if row >= docs_at_once or held >= asked_at_once:
                    yield from flush(chunk, parts)
                    chunk, row, held, parts = chunk + 1, 0, 0, []
        if parts:
            yield from flush(chunk, parts)

    return score


LOOKED_UP = "chunk bigint, keys binary, counts binary, levels binary"


def asked_slice(slices_: pa.Table, keys: np.ndarray, lowest: int) -> np.ndarray:
    """Levels of n-grams by their bucket's slice, if it has one."""
    if not slices_.num_rows:
        return np.zeros(len(keys), np.int64)
    data = np.frombuffer(slices_.column("slice")[0].as_buffer(), np.uint8)
    return probed_levels(data, 0, np.uint64(8 * len(data)), keys, lowest)


def word_answerer(lowest: int):
    def answer(asked: pa.Table, slices_: pa.Table) -> pa.Table:
        """Counts and levels of one bucket's words for the chunks that asked."""
        held, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        if slices_.num_rows:
            held = np.frombuffer(slices_.column("keys")[0].as_buffer(), np.uint64)
            counts = np.frombuffer(slices_.column("counts")[0].as_buffer(), np.int64)
        out = []
        for i in range(asked.num_rows):
            keys = np.frombuffer(asked.column("keys")[i].as_buffer(), np.uint64)
            found = np.zeros(len(keys), np.int64)
            if len(held):
                place = np.minimum(np.searchsorted(held, keys), len(held) - 1)
                found = np.where(held[place] == keys, counts[place], 0)
            levels = asked_slice(slices_, keys, lowest).astype(np.uint8)
            out.append((asked.column("chunk")[i].as_py(), keys.tobytes(), found.tobytes(), levels.tobytes()))
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        columns = list(zip(*out)) or [[], [], [], []]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["chunk", "keys", "counts", "levels"])

    return answer


RESOLVED = SCORED + ", add binary, more binary, add_rows binary"


def resolver(bits: int):
    def resolve(tokens: pa.Table, answers: pa.Table) -> pa.Table:
        """A chunk's tokens that waited for words: base scores, cells, and questions on pairs."""
        chunk = tokens.column("chunk")[0].as_py()
        own = np.concatenate([unpacked(t.as_buffer(), TOKEN) for t in tokens.column("tokens")]).copy()
        keys, counts, levels = (
            np.concatenate([np.frombuffer(x.as_buffer(), t) for x in answers.column(c)])
            for c, t in (("keys", np.uint64), ("counts", np.int64), ("levels", np.uint8))
        )
        order = np.argsort(keys)
        keys, counts, levels = keys[order], counts[order], levels[order]
        rare = own["own_level"] == UNKNOWN
        found = counts[np.searchsorted(keys, own["own"][rare])]
        rows, back = np.unique(own["row"][rare], return_inverse=True)
        add = np.bincount(back, weights=np.log10(found + 1.0), minlength=len(rows))
        more = np.bincount(back, weights=found > 0, minlength=len(rows)).astype(np.int64)
        for c in ("own", "before"):
            asked = own[f"{c}_level"] == UNKNOWN
            own[f"{c}_level"][asked] = levels[np.searchsorted(keys, own[c][asked])]
        sums = {"chunk": [chunk], "add": [add.tobytes()], "more": [more.tobytes()], "add_rows": [rows.astype(np.int32).tobytes()]}
        out = [*map(pa.Table.from_batches, ([b] for b in sorted_out(chunk, bits, own)))]
        names = [c.split()[0] for c in RESOLVED.split(", ")]
        kinds = dict(zip(names, [*SCORED_KINDS, *[pa.binary()] * 3]))

        def whole(columns: dict, n: int) -> pa.Table:
            return pa.table({c: columns[c] if c in columns else pa.nulls(n, kinds[c]) for c in names}, pa.schema(kinds.items()))

        tables = [whole({c: t.column(c) for c in t.column_names}, t.num_rows) for t in out]
        tables.append(whole({c: pa.array(v, kinds[c]) for c, v in sums.items()}, 1))
        return pa.concat_tables(tables)

    return resolve


CELLS = "chunk bigint, rows binary, cells binary, n binary"


def pair_answerer(lowest: int):
    def answer(asked: pa.Table, slices_: pa.Table) -> pa.Table:
        """Cells of the tokens that asked for one bucket's pairs."""
        out = []
        for i in range(asked.num_rows):
            keys = np.frombuffer(asked.column("keys")[i].as_buffer(), np.uint64)
            rows, cells = (unpacked(asked.column(c)[i].as_buffer(), t) for c, t in (("rows", np.int32), ("cells", np.uint32)))
            levels = asked_slice(slices_, keys, lowest).astype(np.uint32)
            out.append((asked.column("chunk")[i].as_py(), *cell_columns(rows, cells | levels)))
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        columns = list(zip(*out)) or [[], [], [], []]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["chunk", "rows", "cells", "n"])

    return answer


def learnt_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tasks: how many tokens of the texts learnt from have each cell."""
    total: dict[int, int] = {}
    for batch in batches:
        for i in range(batch.num_rows):
            cells, n = (unpacked(batch.column(c)[i].as_buffer(), np.uint32) for c in ("cells", "n"))
            stay = cells >= LEARNT
            distinct, back = np.unique(cells[stay], return_inverse=True)
            for cell, k in zip(distinct.tolist(), np.bincount(back, weights=n[stay], minlength=len(distinct)).tolist()):
                total[cell] = total.get(cell, 0) + int(k)
    yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in (total.keys(), total.values())], ["cell", "n"])


RESULT = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def completer(shares: np.ndarray, size: int):
    def complete(docs: pa.Table, answers: pa.Table) -> pa.Table:
        """A chunk's documents with all that was found of them, in a fixed order."""
        docs = docs.sort_by("row")
        known, base = docs.column("known").to_numpy().copy(), docs.column("base").to_numpy().copy()
        parts: dict[str, list] = {"rows": [], "cells": [], "n": []}
        for i in range(answers.num_rows):
            row = {c: answers.column(c)[i].as_py() for c in ("rows", "cells", "n", "add", "more", "add_rows")}
            if row["add"] is not None:
                at = np.frombuffer(row["add_rows"], np.int32)
                base[at] += np.frombuffer(row["add"], np.float64)
                known[at] += np.frombuffer(row["more"], np.int64)
            else:
                for c, t in (("rows", np.int32), ("cells", np.uint32), ("n", np.uint32)):
                    parts[c].append(unpacked(row[c], t))
        rows, cells, n = (np.concatenate(parts[c]) for c in ("rows", "cells", "n"))
        order = np.lexsort((cells, rows))
        score = np.bincount(rows[order], weights=n[order] * cell_scores(cells[order], shares, size), minlength=len(base))
        columns = [docs.column(c) for c in ("doc_id", "held_out", "n_tokens")]
        return pa.Table.from_arrays(
            [*columns, pa.array(known), pa.array(base), pa.array(score)], [c.split()[0] for c in RESULT.split(", ")]
        )

    return complete


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the files of shuffles whose results are landed and which no DataFrame names any more.

    Spark's cleaner does so when the driver's garbage is collected, of itself
    every half hour only; until then their files take the disks' room.
    """
    gc.collect()
    spark._jvm.System.gc()


class Parts:
    """A landed table in parts, each deleted as soon as it is read for the last time."""

    def __init__(self, df: DataFrame, name: str, part: Column):
        self.spark, self.path = df.sparkSession, fresh_path(df.sparkSession, name)
        rows = df.withColumn("part", part)
        rows.write.partitionBy("part").parquet(self.path)
        self.schema = rows.schema

    def read(self, part: str) -> DataFrame:
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        return rows.filter(F.col("part") == part).drop("part")

    def drop(self, *parts: str) -> None:
        for part in parts:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/part={part}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def part_of(passes: int) -> Column:
    """The part of a row of ``SCORED``; questions on pairs and waiting tokens are in one part for each pass."""
    by_chunk = F.pmod(F.xxhash64("chunk"), F.lit(passes))
    part = F.when(F.col("row").isNotNull(), "docs").when(F.col("n").isNotNull(), "cells")
    part = part.when(F.col("tokens").isNotNull(), F.concat(F.lit("waiting"), by_chunk)).when(F.col("kind") == UNIGRAM, "words")
    return part.when(F.col("kind") == BIGRAM, F.concat(F.lit("pairs"), F.col("bucket") % passes)).otherwise("sums")


def bucket_bits(docs: DataFrame, bytes_per_bucket: int) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(6, math.ceil(math.log2(max(1, size / bytes_per_bucket))))


def score_documents(
    docs: DataFrame,
    held_out: Column,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    bytes_per_bucket: int = 64 * 1024 * 1024,
    docs_at_once: int = 20_000,
    asked_at_once: int = 500_000,
    least: tuple[int, int] = (1, 1),
    passes: int = 4,
    **how,
) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    The model learns from the documents that are not ``held_out``; scores are
    log10 probabilities of whole texts. The number of buckets follows the size
    of the texts. The shares are fitted on all documents learnt from. Questions
    are answered in ``passes``, so that the disks hold a part of them twice, as
    table and as shuffle, and none that is answered.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        raw_text(text_col).alias("text"),
    )
    spark = docs.sparkSession
    bits = bucket_bits(rows, bytes_per_bucket)
    model, sliced = train(rows.filter(~F.col("held_out")).select("text"), bits, least=least, **how)
    lowest = [int(level_of(np.array([n]))[0]) for n in least]
    size = model.tokens + model.types + 1
    release_shuffles(spark)  # that of the counts is as large as the texts
    shared = spark.sparkContext.broadcast(model.parts())
    rows = rows.withColumn("learnt", ~F.col("held_out"))
    scored = Parts(rows.mapInArrow(scorer(shared, bits, docs_at_once, asked_at_once), SCORED), "lm-scores", part_of(passes))

    def answered(asked: list[DataFrame], kind: int, columns: list[str]) -> tuple:
        found = reduce(DataFrame.unionByName, [x.select("bucket", "chunk", "keys", "rows", "cells") for x in asked])
        held = sliced.filter(F.col("kind") == kind).select("bucket", *columns)
        held = held.join(found.select("bucket").distinct(), "bucket", "left_semi")
        return found.groupBy("bucket").cogroup(held.groupBy("bucket"))

    def word_answers() -> Parts:
        both = answered([scored.read("words")], UNIGRAM, ["keys", "counts", "slice"])
        by_chunk = F.pmod(F.xxhash64("chunk"), F.lit(passes))
        return Parts(both.applyInArrow(word_answerer(lowest[UNIGRAM]), LOOKED_UP), "lm-words", by_chunk.cast("string"))

    def resolved_part(k: int) -> Parts:
        both = scored.read(f"waiting{k}").select("chunk", "tokens").groupBy("chunk").cogroup(words.read(str(k)).groupBy("chunk"))
        return Parts(both.applyInArrow(resolver(bits), RESOLVED), "lm-resolved", part_of(passes))

    def pair_answers(k: int) -> DataFrame:
        both = answered([x.read(f"pairs{k}") for x in (scored, *resolved)], BIGRAM, ["slice"])
        return land(both.applyInArrow(pair_answerer(lowest[BIGRAM]), CELLS), "lm-pairs")

    words, resolved, pairs = word_answers(), [], []
    scored.drop("words")
    release_shuffles(spark)
    for k in range(passes):
        resolved.append(resolved_part(k))
        scored.drop(f"waiting{k}")
        words.drop(str(k))
        release_shuffles(spark)
    for k in range(passes):
        pairs.append(pair_answers(k))
        for table in (scored, *resolved):
            table.drop(f"pairs{k}")
        release_shuffles(spark)
    cells = [x.read("cells") for x in (scored, *resolved)] + pairs
    cells = reduce(DataFrame.unionByName, [x.select("chunk", "rows", "cells", "n") for x in cells])
    total = cells.select("cells", "n").mapInArrow(learnt_cells, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    total = np.array(sorted((r.cell, r.n) for r in total.collect()), np.int64).reshape(-1, 2)
    shares = fit_shares(total[:, 0], total[:, 1], size) if len(total) else np.zeros(LEVELS)
    sums = reduce(DataFrame.unionByName, [x.read("sums").select("chunk", "add", "more", "add_rows") for x in resolved])
    found = cells.unionByName(sums, allowMissingColumns=True)
    own = scored.read("docs").select("chunk", "row", "doc_id", "held_out", "n_tokens", "known", "base")
    result = own.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(completer(shares, size), RESULT)
    return result.withColumn("train_tokens", F.lit(model.tokens).cast("bigint"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a model of six sevenths of them."""
    docs = documents(spark, sf_dir)
    return score_documents(docs, remainder("doc_id", 7) == 2).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
