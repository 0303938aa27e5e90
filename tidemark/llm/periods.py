"""Periodic runs of words, by an enhanced suffix array.

Words are what lies between blanks. A run is a longest stretch with smallest
period q that holds at least two periods and ``least`` words. Some thousand
words of neighbouring documents are taken at once; equal words of different
documents count as different, and each document ends with a word of its own, so
nothing is found across documents.

1. Ranks of prefixes of 1, 2, 4 … words give the suffix array ``sa``, its
   inverse, and the common prefixes of neighbours in it.
2. A stack walks the common prefixes and gives all LCP intervals with the bounds
   of their children; no tree is built.
3. In an interval of depth d, every suffix i of all children but the largest is
   tested: does ``inverse[i + d]``, or ``inverse[i - d]``, lie in the interval
   but in another child? Then d words stand twice, and the word behind them
   breaks the period: a branching square. Every run ends with one.
4. By ascending d, squares are rotated to the left as long as they stay
   squares, which gives the run. Squares at the end of a run whose period
   divides theirs belong to it.

A document's memory is some 100 bytes a word, and 4 for each doubling that its
longest repeat takes. Null and empty texts have no words and no runs. Rows that
repeat a doc_id are documents of their own. An empty table gives no rows. Extra
columns are not read. There is no shuffle.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import documents, raw_text, slices

TEXT_BUDGET = 1_000_000
SUFFIXES_AT_ONCE = 4_000_000
RUN = "struct<start:bigint,length:bigint,period:bigint>"
FOUND = f"doc_id bigint, n_words bigint, runs array<{RUN}>, collapsed string"

Run = tuple[int, int, int]
Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


def group_starts(new: np.ndarray) -> np.ndarray:
    """For each place the last place at or before it where ``new`` is true."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def changes(values: np.ndarray) -> np.ndarray:
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return new


def prefix_ranks(ids: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4 … words, until they are all different.

    A rank is the place of the first of its equals, so ranks of suffixes that
    are told apart stay; only the others are sorted again.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    rank = np.empty(n, np.int32)
    new = changes(ids[order])
    rank[order] = group_starts(new)
    levels, width = [rank], 1
    unsettled = order[~(new & np.append(new[1:], True))]
    while len(unsettled):
        ahead = unsettled + width
        behind = np.where(ahead < n, rank[np.minimum(ahead, n - 1)].astype(np.int64) + 1, 0)
        key = rank[unsettled].astype(np.int64) * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        unsettled, key = unsettled[order], key[order]
        old, new = rank[unsettled], changes(key)
        rank = rank.copy()
        rank[unsettled] = old + (group_starts(new) - group_starts(changes(old)))
        levels.append(rank)
        unsettled = unsettled[~(new & np.append(new[1:], True))]
        width *= 2
    return levels


def common_prefixes(levels: list[np.ndarray], sa: np.ndarray) -> np.ndarray:
    """``lcp[k]``: words that suffixes ``sa[k - 1]`` and ``sa[k]`` have in common; 0 for k = 0."""
    n = len(sa)
    lcp = np.zeros(n, np.int64)
    k = 1 + np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]])
    a, b = sa[k - 1], sa[k]
    for level in reversed(range(len(levels))):
        inside = np.maximum(a, b) < n
        same = inside & (levels[level][np.where(inside, a, 0)] == levels[level][np.where(inside, b, 0)])
        step = same.astype(np.int64) << level
        a, b = a + step, b + step
    lcp[k] = a - sa[k - 1]
    return lcp


def intervals(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``depth, begin, end, children, cuts`` of all LCP intervals but the one of depth 0.

    ``cuts`` holds, one interval after another, where its second and further
    children begin.
    """
    depth, begin, end, children, cuts = (array("q") for _ in range(5))
    stack: list[tuple[int, int, list[int]]] = []
    places = np.flatnonzero(lcp)
    # Behind each stretch of positive values all intervals close.
    closing = np.flatnonzero(np.append(lcp[1:] == 0, True) & (lcp > 0)) + 1
    visits = np.concatenate([places, closing])
    values = np.concatenate([lcp[places], np.zeros(len(closing), np.int64)])
    order = np.argsort(visits, kind="stable")
    for k, common in zip(visits[order].tolist(), values[order].tolist()):
        first = k - 1
        while stack and stack[-1][0] > common:
            d, first, inner = stack.pop()
            depth.append(d)
            begin.append(first)
            end.append(k)
            children.append(len(inner) + 1)
            cuts.extend(inner)
        if common:
            if stack and stack[-1][0] == common:
                stack[-1][2].append(k)
            else:
                stack.append((common, first, [k]))
    return tuple(np.frombuffer(x, np.int64) if len(x) else np.zeros(0, np.int64) for x in (depth, begin, end, children, cuts))


def branching_squares(sa: np.ndarray, inverse: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``start, period`` of every square behind which the period breaks."""
    depth, begin, end, children, cuts = intervals(lcp)
    if not len(depth):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    heads = np.cumsum(children) - children
    head = np.zeros(int(children.sum()), bool)
    head[heads] = True
    low = np.empty(len(head), np.int64)
    low[head], low[~head] = begin, cuts
    high = np.empty(len(head), np.int64)
    high[np.append(head[1:], True)], high[np.append(~head[1:], False)] = end, cuts
    size = high - low
    owner = np.repeat(np.arange(len(depth)), children)
    largest = np.flatnonzero(size == np.maximum.reduceat(size, heads)[owner])
    _, first = np.unique(owner[largest], return_index=True)
    small = np.ones(len(size), bool)
    small[largest[first]] = False
    low, high, owner, size = low[small], high[small], owner[small], size[small]
    starts, periods = [], []
    reach = np.cumsum(size)
    at = 0
    while at < len(size):
        # Children that hold together so many suffixes, but one at least.
        to = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + SUFFIXES_AT_ONCE, "right")))
        part = slice(at, to)
        child = np.repeat(np.arange(at, to), size[part])
        own = np.arange(len(child)) - np.repeat(np.cumsum(size[part]) - size[part], size[part]) + low[child]
        i, d = sa[own], depth[owner[child]]
        for other, start in ((i + d, i), (i - d, i - d)):
            inside = (other >= 0) & (other < len(sa))
            place = inverse[np.where(inside, other, 0)]
            found = inside & (place >= begin[owner[child]]) & (place < end[owner[child]])
            found &= (place < low[child]) | (place >= high[child])
            starts.append(start[found])
            periods.append(d[found])
        at = to
    squares = np.unique(np.stack([np.concatenate(periods), np.concatenate(starts)]), axis=1)
    return squares[1], squares[0]


def rotated(ids: np.ndarray, start: int, period: int) -> int:
    """The leftmost start of the squares that the one at ``start`` rotates into."""
    step = 16
    while start:
        low = max(0, start - step)
        breaks = np.flatnonzero(ids[low:start] != ids[low + period : start + period])
        if len(breaks):
            return low + int(breaks[-1]) + 1
        start, step = low, 2 * step
    return 0


def runs_of(ids: np.ndarray) -> list[Run]:
    """``start, length, period`` of all runs of two periods and more, by ascending period.

    The last word must be the only one of its kind.
    """
    if len(ids) < 2:
        return []
    levels = prefix_ranks(ids)
    inverse = levels[-1].astype(np.int64)
    sa = np.empty(len(ids), np.int64)
    sa[inverse] = np.arange(len(ids))
    lcp = common_prefixes(levels, sa)
    del levels
    ended: defaultdict[int, list[tuple[int, int]]] = defaultdict(list)
    out = []
    for start, period in zip(*(x.tolist() for x in branching_squares(sa, inverse, lcp))):
        end = start + 2 * period
        known = ended[end]
        if any(period % q == 0 and first <= start for q, first in known):
            continue
        first = rotated(ids, start, period)
        known.append((period, first))
        out.append((first, end - first, period))
    return out


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, different in each text and with an end of its own, and where the texts begin."""
    ids, begins, base = array("q"), [], 0
    for words in texts:
        begins.append(len(ids))
        own: dict[bytes, int] = {}
        ids.extend([own.setdefault(word, base + len(own)) for word in words])
        base += len(own)
        ids.append(base)
        base += 1
    return np.frombuffer(ids, np.int64) if len(ids) else np.zeros(0, np.int64), np.array(begins, np.int64)


def runs_of_texts(texts: list[list[bytes]], least: int) -> list[list[Run]]:
    """The runs of each text, by start and period."""
    ids, begins = numbered(texts)
    out: list[list[Run]] = [[] for _ in texts]
    found = [run for run in runs_of(ids) if run[1] >= least]
    owners = np.searchsorted(begins, [run[0] for run in found], "right") - 1
    for (start, length, period), owner in zip(found, owners.tolist()):
        out[owner].append((start - int(begins[owner]), length, period))
    return [sorted(runs, key=lambda run: (run[0], run[2])) for runs in out]


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words that no run repeats, one blank between."""
    if not runs:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def finder(least: int, rewrite: Rewrite | None):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        for batch in batches:
            for begin, texts in slices(batch, "text", TEXT_BUDGET):
                keys = batch.column("doc_id").slice(begin, len(texts))
                words = [text.split() for text in texts]
                if rewrite:
                    words = [rewrite(key, own) for key, own in zip(keys.to_pylist(), words)]
                runs = runs_of_texts(words, least)
                columns = [
                    keys,
                    pa.array([len(own) for own in words], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), run)) for run in own] for own in runs], kind),
                    pa.array([collapsed(*pair).decode() for pair in zip(words, runs)], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    return find


def find_runs(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 12,
    rewrite: Rewrite | None = None,
) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every document.

    ``runs`` are by start and period. ``collapsed`` is the text without the
    words behind the first period of any run, one blank between words.
    ``rewrite`` may change a document's words before.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), raw_text(text_col).alias("text"))
    return rows.mapInArrow(finder(least, rewrite), FOUND)


def planted(key: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's rewriting: every tenth document becomes periodic from some word on; a null key counts as no digits."""
    drawn = zlib.crc32(b"" if key is None else str(key).encode())
    rest, n = drawn // 10, len(words)
    if drawn % 10 or not n:
        return words
    begin = rest % n
    period = 1 + (n - begin) // (3 + rest % 8)
    return words[:begin] + [words[begin + i % period] for i in range(n - begin)]


def op11_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents: their number, the longest, and digests of all and of what they leave."""
    found = find_runs(documents(spark, sf_dir), rewrite=planted)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    longest = found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.col2")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.col3")).alias("period"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    milli = F.expr("1000 * length div period").alias("exponent_milli")
    return longest.select("doc_id", "n_runs", "start", "length", "period", milli, "runs_sha256", "collapsed_sha256")
