"""Counts of n-grams inside tasks, on Arrow batches of word lists.

Words and n-grams are numbered within a slice of posts, counted as numbers, and
written out as text once for each row that leaves the task. A slice has
``SLICE_WORDS`` words at most, or one post that has more, so that bounds what a
task holds. Null words are part of no n-gram.

n-grams have hashes, equal in all slices, and buckets by their hash. Buckets
are a first sieve only: whatever passes it is told apart by its text.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Executors need no path to this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_WORDS = 500_000
# Buckets whose counts travel in one row.
PART = 1 << 16
# Places hashed at once: what is in between stays in the cache.
BLOCK = 1 << 14


def word_slices(batch: pa.RecordBatch, words: str, most: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of at most ``most`` words, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(words)), 0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < len(ends):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


class Slice:
    """The words of consecutive posts, coded by the distinct ones."""

    def __init__(self, lists: pa.Array):
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        coded = lists.flatten().dictionary_encode()
        self.words, self.keys = coded.dictionary, None
        self.ids = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        self.post = np.repeat(np.arange(len(lengths), dtype=np.int64), lengths)

    def starts(self, sizes: Sequence[int]) -> Iterator[tuple[int, np.ndarray]]:
        """``n`` and the places of the first words of all n-grams; for each of ``sizes``."""
        at = np.flatnonzero(self.ids >= 0)
        for n in range(1, max(sizes) + 1):
            if n > 1:
                at = at[at + (n - 1) < len(self.ids)]
                last = at + (n - 1)
                at = at[(self.post[last] == self.post[at]) & (self.ids[last] >= 0)]
            if n in sizes:
                yield n, at

    def buckets(self, at: np.ndarray, n: int, count: int) -> np.ndarray:
        """Buckets by hash of the n-grams at these places."""
        if not len(at):
            return np.zeros(0, np.int64)
        if self.keys is None:
            codes = map(zlib.crc32, self.words.cast(pa.binary()).to_pylist())
            self.keys = np.fromiter(codes, np.uint64, len(self.words))[self.ids]
        out = np.empty(len(at), np.int64)
        for begin in range(0, len(at), BLOCK):
            places = at[begin : begin + BLOCK]
            part = np.full(len(places), n, np.uint64)
            for k in range(n):
                part ^= self.keys[places + k]
                part *= np.uint64(0x9E3779B97F4A7C15)
                part ^= part >> np.uint64(32)
            part *= np.uint64(0xD6E8FEB86659FD93)
            part >>= np.uint64(32)
            part *= np.uint64(count)
            out[begin : begin + BLOCK] = part >> np.uint64(32)
        return out

    def numbered(self, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The number of the n-gram at each place, and one place of each number."""
        number, base = self.ids[at], max(len(self.words), 1)
        count = base
        for k in range(1, n):
            if count * base >= 1 << 63:
                coded = pa.array(number).dictionary_encode()
                number, count = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)
            number, count = number * base + self.ids[at + k], count * base
        coded = pa.array(number).dictionary_encode()
        number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        first = np.zeros(len(coded.dictionary), np.int64)
        first[number] = at
        return number, first

    def texts(self, first: np.ndarray, n: int) -> pa.Array:
        parts = [self.words.take(pa.array(self.ids[first + k])) for k in range(n)]
        return parts[0] if n == 1 else pc.binary_join_element_wise(*parts, " ")


def term_marks(terms: Sequence[str], buckets: int = 1 << 22) -> dict[int, bytes]:
    """For each n the buckets that hold one of these terms, as bits."""
    by_size: dict[int, list[list[str]]] = {}
    for term in terms:
        words = term.split(" ")
        by_size.setdefault(len(words), []).append(words)
    marks = {}
    for n, lists in by_size.items():
        part, held = Slice(pa.array(lists, pa.list_(pa.string()))), np.zeros(buckets, bool)
        for _, at in part.starts([n]):
            held[part.buckets(at, n, buckets)] = True
        marks[n] = np.packbits(held).tobytes()
    return marks


def unpacked_marks(wanted) -> dict[int, np.ndarray] | None:
    """Broadcast marks as Booleans."""
    return None if wanted is None else {n: np.unpackbits(np.frombuffer(b, np.uint8)).view(bool) for n, b in wanted.value.items()}


def numbered_grams(
    lists: pa.Array, sizes: Sequence[int], marks: dict[int, np.ndarray] | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray, Slice, np.ndarray]]:
    """``n``, the post and number of every n-gram, their slice, and a place of each number; for each of ``sizes``.

    With ``marks`` only n-grams of marked buckets.
    """
    part = Slice(lists)
    for n, at in part.starts(sizes):
        if marks is not None:
            if n not in marks:
                continue
            at = at[marks[n][part.buckets(at, n, len(marks[n]))]]
        number, first = part.numbered(at, n)
        yield n, part.post[at], number, part, first


def by_post(post: np.ndarray, number: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Post, number and count of every n-gram of every post, once each."""
    key = np.sort(post * max(count, 1) + number)
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    held = key[starts]
    return held // max(count, 1), held % max(count, 1), np.diff(starts, append=len(key))


def post_counter(sizes: Sequence[int], words: str, keep: Sequence[str], most: int = SLICE_WORDS, wanted=None) -> Callable:
    """Batches of ``keep…, words`` to ``keep…, term, tf``: a row for each post and distinct n-gram, or each in marked buckets."""

    def count(batches):
        marks = unpacked_marks(wanted)
        for batch in batches:
            for piece in word_slices(batch, words, most):
                for n, post, number, part, first in numbered_grams(piece.column(words), sizes, marks):
                    rows, held, tf = by_post(post, number, len(first))
                    kept = [piece.column(c).take(pa.array(rows)) for c in keep]
                    columns = [*kept, part.texts(first, n).take(pa.array(held)), pa.array(tf, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=[*keep, "term", "tf"])

    return count


def known_counter(
    sizes: Sequence[int], words: str, keep: Sequence[str], columns: Sequence[str], shared, wanted, most: int = SLICE_WORDS
) -> Callable:
    """Batches of ``keep…, words`` to ``keep…, tf, columns…``: a row for each post and known n-gram.

    ``shared`` is the broadcast table of the known, told apart by ``term``, ``wanted`` their marks.
    """

    def count(batches):
        marks, known = unpacked_marks(wanted), shared.value
        terms = known.column("term").combine_chunks()
        size = pc.add(pc.count_substring(terms, " "), 1).to_numpy(zero_copy_only=False)
        places = {n: np.flatnonzero(size == n) for n in sizes}
        sets = {n: terms.take(pa.array(at)) for n, at in places.items()}
        values = [known.column(c).combine_chunks() for c in columns]
        for batch in batches:
            for piece in word_slices(batch, words, most):
                for n, post, number, part, first in numbered_grams(piece.column(words), sizes, marks):
                    found = pc.fill_null(pc.index_in(part.texts(first, n), value_set=sets[n]), -1)
                    found = found.to_numpy(zero_copy_only=False).astype(np.int64)[number]
                    rows, held, tf = by_post(post[found >= 0], found[found >= 0], len(sets[n]))
                    rows, held = pa.array(rows), pa.array(places[n][held])
                    kept = [piece.column(c).take(rows) for c in keep]
                    arrays = [*kept, pa.array(tf, pa.int64()), *[v.take(held) for v in values]]
                    yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "tf", *columns])

    return count


def sliced_counts(
    piece: pa.RecordBatch, words: str, sizes: Sequence[int], marks: dict[int, np.ndarray] | None = None
) -> Iterator[tuple[int, Slice, np.ndarray, np.ndarray, np.ndarray]]:
    """``n``, the slice, and of its distinct n-grams a place, the count and the number of posts."""
    for n, post, number, part, first in numbered_grams(piece.column(words), sizes, marks):
        total = np.bincount(number, minlength=len(first))
        df = np.bincount(by_post(post, number, len(first))[1], minlength=len(first))
        yield n, part, first, total, df


def slice_counter(sizes: Sequence[int], words: str, most: int = SLICE_WORDS, wanted=None) -> Callable:
    """Batches of ``words`` to ``n, term, total, df`` of each slice, or of its n-grams in marked buckets."""

    def count(batches):
        marks = unpacked_marks(wanted)
        for batch in batches:
            for piece in word_slices(batch, words, most):
                for n, part, first, total, df in sliced_counts(piece, words, sizes, marks):
                    columns = [np.full(len(first), n, np.int32), part.texts(first, n), total, df]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["n", "term", "total", "df"])

    return count


PACKED = "n int, bucket int, texts binary, lengths binary, totals binary, dfs binary"


def cut_bytes(data: pa.Buffer, cuts: np.ndarray) -> pa.Array:
    """A buffer as the values between these places, without a copy."""
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32)), data])


def packer(sizes: Sequence[int], words: str, buckets: int, most: int = SLICE_WORDS) -> Callable:
    """Batches of ``words`` to the counts of each slice by bucket, all of a bucket in one row."""

    def pack(batches):
        for batch in batches:
            for piece in word_slices(batch, words, most):
                for n, part, first, total, df in sliced_counts(piece, words, sizes):
                    if not len(first):
                        continue
                    bucket = part.buckets(first, n, buckets)
                    order = np.argsort(bucket.astype(np.min_scalar_type(buckets)), kind="stable")
                    texts, bucket = part.texts(first[order], n), bucket[order]
                    begins = np.flatnonzero(np.diff(bucket, prepend=-1))
                    cuts = np.append(begins, len(bucket))
                    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
                    numbers = [np.diff(ends), total[order], df[order]]
                    columns = [
                        pa.array(np.full(len(begins), n, np.int32)),
                        pa.array(bucket[begins].astype(np.int32)),
                        cut_bytes(texts.buffers()[2] or pa.py_buffer(b""), ends[cuts]),
                        *[cut_bytes(pa.py_buffer(x.astype(np.int32)), 4 * cuts) for x in numbers],
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in PACKED.split(", ")])

    return pack


def unpacked_totals(group: pa.Table) -> pa.Table:
    """Add up one bucket: ``n, term, total, df``."""
    sizes, out = group.column("n").to_numpy(), []
    for n in np.unique(sizes).tolist():
        part = group.filter(pa.array(sizes == n))
        joined = {c: b"".join(x.as_buffer() for x in part.column(c)) for c in ("texts", "lengths", "totals", "dfs")}
        lengths, total, df = (np.frombuffer(joined[c], np.int32) for c in ("lengths", "totals", "dfs"))
        ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        terms = pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(joined["texts"])])
        rows = pa.table({"term": terms, "total": total.astype(np.int64), "df": df.astype(np.int64)})
        rows = rows.group_by("term", use_threads=False).aggregate([("total", "sum"), ("df", "sum")])
        columns = [rows.column("term").cast(pa.string()), rows.column("total_sum"), rows.column("df_sum")]
        out.append(pa.table([pa.array(np.full(rows.num_rows, n, np.int32)), *columns], names=["n", "term", "total", "df"]))
    return pa.concat_tables(out)


BUCKETS = "n int, part int, counts binary"


def bucket_counter(sizes: Sequence[int], words: str, buckets: int, most: int = SLICE_WORDS) -> Callable:
    """Batches of ``words`` to how many n-grams of a task fall into each bucket."""

    def count(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece in word_slices(batch, words, most):
                part = Slice(piece.column(words))
                for n, at in part.starts(sizes):
                    if n not in held:
                        held[n] = np.zeros(buckets, np.int64)
                    # A slice fills few of the buckets: a table of all would cost more than its n-grams.
                    np.add.at(held[n], part.buckets(at, n, buckets), 1)
        for n, counts in held.items():
            parts = [counts[i : i + PART].astype(np.uint32) for i in range(0, buckets, PART)]
            data = [pa.compress(x.tobytes(), codec="zstd", asbytes=True) for x in parts]
            columns = [pa.array([n] * len(parts), pa.int32()), pa.array(range(len(parts)), pa.int32()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["n", "part", "counts"])

    return count


def bucket_adder(buckets: int) -> Callable:
    def add(group: pa.Table) -> pa.Table:
        """The counts of one part of the buckets over all tasks."""
        first = group.column("part")[0].as_py() * PART
        total = np.zeros(min(PART, buckets - first), np.int64)
        for data in group.column("counts"):
            total += np.frombuffer(pa.decompress(data.as_buffer(), 4 * len(total), codec="zstd"), np.uint32)
        kinds = [pa.int32(), pa.int32(), pa.binary()]
        row = [group.column("n")[0].as_py(), group.column("part")[0].as_py(), total.tobytes()]
        return pa.table([pa.array([v], k) for v, k in zip(row, kinds)], names=["n", "part", "counts"])

    return add


def bucket_levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many buckets of a part have each count: ``n, key, rows``."""
    for batch in batches:
        for n, counts in zip(batch.column("n").to_pylist(), batch.column("counts")):
            counts = np.frombuffer(counts.as_buffer(), np.int64)
            key, rows = np.unique(counts[counts > 0], return_counts=True)
            columns = [pa.array(np.full(len(key), n, np.int32)), pa.array(key), pa.array(rows.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["n", "key", "rows"])


def bucket_marker(least: dict[int, int], below: dict[int, int]) -> Callable:
    """Parts of buckets to the bits of those that count ``least`` of their n, and not as much as ``below``."""

    def mark(batches):
        for batch in batches:
            numbers = zip(batch.column("n").to_pylist(), batch.column("counts"))
            counted = [(n, np.frombuffer(counts.as_buffer(), np.int64)) for n, counts in numbers]
            held = [(c >= least.get(n, 1)) & (c < below.get(n, 1 << 62)) for n, c in counted]
            bits = pa.array([np.packbits(x).tobytes() for x in held], pa.binary())
            columns = [batch.column("n"), batch.column("part"), bits, pa.array([int(x.sum()) for x in held], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["n", "part", "bits", "marked"])

    return mark


def margin_counter(sizes: Sequence[int], words: str, keep: Sequence[str], shared, wanted, intercept: float, most: int = SLICE_WORDS) -> Callable:
    """Batches of ``keep…, words`` to ``keep…, margin``: the weights of a post's n-grams, added up."""

    def count(batches):
        marks = unpacked_marks(wanted)
        known, weights = shared.value
        known, weights = pa.array(known, pa.string()), np.append(np.array(weights, np.float64), 0.0)
        for batch in batches:
            for piece in word_slices(batch, words, most):
                margin = np.zeros(piece.num_rows)
                for n, post, number, part, first in numbered_grams(piece.column(words), sizes, marks):
                    place = pc.fill_null(pc.index_in(part.texts(first, n), value_set=known), len(known))
                    weight = weights[place.to_numpy(zero_copy_only=False)]
                    margin += np.bincount(post, weights=weight[number], minlength=piece.num_rows)
                columns = [*[piece.column(c) for c in keep], pa.array(margin + intercept)]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "margin"])

    return count
