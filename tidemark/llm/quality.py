"""Document quality by a linear-chain conditional random field over lines.

Every line that is not blank is a node with two states, good and bad. A line's
features, with those of the lines before and after it, give its potential; a
transition matrix ties neighbours. Forward-backward gives each line's marginal
of being good; a document's raw score is their mean, weighted by line length,
and a logistic curve fitted on the training sample makes it a probability.

Features are shares of byte classes and word statistics of the text alone.
Lines are trained with their document's label. Null, empty and blank texts have
no line; their score is the share of label 1 in the sample. An empty table
gives no rows; a sample without both labels gives that share to all.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import documents, free_name, raw_text, remainder, table

# Byte classes: 0 other, 1 lower-case or non-ASCII letter, 2 upper-case, 3 digit, 4 blank, 5 sentence mark, 6 bar.
CLASSES = np.zeros(256, np.uint8)
CLASSES[[ord(c) for c in "abcdefghijklmnopqrstuvwxyz"]] = 1
CLASSES[128:] = 1
CLASSES[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 2
CLASSES[[ord(c) for c in "0123456789"]] = 3
CLASSES[[ord(c) for c in " \t\r\v\f"]] = 4
CLASSES[[ord(c) for c in ".,;:!?"]] = 5
CLASSES[ord("|")] = 6
N_CLASSES = 7
N_FEATURES = N_CLASSES + 7
BYTES_AT_ONCE = 2_000_000


def lines_of(text: bytes) -> list[bytes]:
    return [line for line in text.split(b"\n") if line.strip()]


def line_features(lines: list[bytes]) -> np.ndarray:
    """One row per line; every feature lies in 0..1 or is a logarithm."""
    size = np.array([len(x) for x in lines])
    starts = size.cumsum() - size
    kinds = CLASSES[np.frombuffer(b"".join(lines), np.uint8)]
    shares = np.empty((len(lines), N_FEATURES), np.float64)
    for k in range(N_CLASSES):
        shares[:, k] = np.add.reduceat(kinds == k, starts, dtype=np.int64) / size
    words = [x.split() for x in lines]
    n = np.array([len(w) for w in words])
    shares[:, N_CLASSES] = [len(set(w)) / len(w) for w in words]
    shares[:, N_CLASSES + 1] = np.log1p(n) / 10
    shares[:, N_CLASSES + 2] = np.log1p(size / n) / 5
    shares[:, N_CLASSES + 3] = [w[-1][-1:] in b".!?" for w in words]
    shares[:, N_CLASSES + 4] = [x.istitle() or not x[:1].isupper() for x in lines]
    shares[:, N_CLASSES + 5] = np.log1p(size) / 10
    shares[:, N_CLASSES + 6] = [sum(map(operator.eq, w, w[1:])) / len(w) for w in words]
    return shares


def chain_features(lines: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Own, previous and next line's features, and a constant; zeros outside the document.

    ``first`` marks the first line of each document.
    """
    before, after = np.zeros_like(lines), np.zeros_like(lines)
    before[1:] = lines[:-1]
    before[first] = 0
    after[:-1] = lines[1:]
    after[:-1][first[1:]] = 0
    return np.hstack([lines, before, after, np.ones((len(lines), 1))])


def marginals(potential: np.ndarray, transition: np.ndarray, counts: np.ndarray):
    """Forward-backward over chains that lie one after another.

    ``potential`` is a line's log-odds of good (state 1); ``transition[a, b]``
    is added for a step from a to b. Returns each line's probability of good,
    the summed probability of each transition, and the log-normaliser of all
    chains. Chains are walked together, position by position.
    """
    order = np.argsort(-counts, kind="stable")
    starts = (counts.cumsum() - counts)[order]
    lengths = counts[order]
    odds = np.stack([np.zeros(len(potential)), potential], axis=1)
    step = np.exp(transition)
    longest = int(lengths[0]) if len(lengths) else 0
    live = [int(np.searchsorted(-lengths, -t, side="left")) for t in range(longest)]
    high = np.maximum(odds.max(axis=1, keepdims=True), 0)
    local = np.exp(odds - high)
    forward, scale = np.empty_like(odds), np.empty(len(odds))
    for t in range(longest):
        at = starts[: live[t]] + t
        row = local[at] if t == 0 else local[at] * (forward[at - 1] @ step)
        scale[at] = row.sum(axis=1)
        forward[at] = row / scale[at][:, None]
    backward = np.ones_like(odds)
    pairs = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        at = starts[: live[t + 1]] + t
        ahead = local[at + 1] * backward[at + 1] / scale[at + 1][:, None]
        pairs += (forward[at].T @ ahead) * step
        backward[at] = ahead @ step.T
    both = forward * backward
    return both[:, 1] / both.sum(axis=1), pairs, float(np.log(scale).sum() + high.sum())


@dataclass
class Model:
    """Feature weights, transitions, and the logistic curve ``slope * raw + offset``; ``base`` for texts without lines."""

    weights: np.ndarray
    transition: np.ndarray
    slope: float
    offset: float
    base: float

    def raw(self, texts: list[bytes]) -> np.ndarray:
        """Length-weighted mean of the lines' marginals of each text; nan without lines."""
        split = [lines_of(t) for t in texts]
        counts = np.array([len(x) for x in split], np.int64)
        out = np.full(len(texts), np.nan)
        flat = [x for lines in split for x in lines]
        if not flat:
            return out
        some = counts[counts > 0]
        first = np.zeros(len(flat), bool)
        first[some.cumsum() - some] = True
        rows = chain_features(line_features(flat), first)
        good, _, _ = marginals(rows @ self.weights, self.transition, some)
        size = np.array([len(x) for x in flat], np.float64)
        starts = some.cumsum() - some
        out[counts > 0] = np.add.reduceat(good * size, starts) / np.add.reduceat(size, starts)
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        raw = self.raw(texts)
        with np.errstate(over="ignore"):
            calibrated = 1 / (1 + np.exp(-(self.slope * raw + self.offset)))
        return np.where(np.isnan(raw), self.base, calibrated)


def fit_chain(rows: np.ndarray, states: np.ndarray, counts: np.ndarray, *, penalty: float, rounds: int):
    """Weights and transitions of highest penalised likelihood, by Adam on the whole sample."""
    weights, transition = np.zeros(rows.shape[1]), np.zeros((2, 2))
    inside = np.ones(len(states), bool)
    inside[counts.cumsum()[:-1]] = False
    inside[0] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (states[:-1][inside[1:]], states[1:][inside[1:]]), 1)
    n = len(counts)
    target = rows.T @ states
    flat = np.zeros(len(weights) + 4)
    mean, square = np.zeros_like(flat), np.zeros_like(flat)
    for i in range(1, rounds + 1):
        weights, transition = flat[:-4], flat[-4:].reshape(2, 2)
        good, pairs, _ = marginals(rows @ weights, transition, counts)
        gradient = np.concatenate([rows.T @ good - target, (pairs - seen).ravel()]) / n + penalty * flat
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        rate = 0.1 * min(1.0, 2.0 * (1 - i / (rounds + 1)))
        flat = flat - rate * (mean / (1 - 0.9**i)) / (np.sqrt(square / (1 - 0.99**i)) + 1e-9)
    return flat[:-4], flat[-4:].reshape(2, 2)


def fit_curve(raw: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic curve through one variable, by Newton steps with a slight pull to zero."""
    design = np.stack([raw, np.ones_like(raw)], axis=1)
    at = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ at))
        gradient = design.T @ (p - labels) + 0.01 * at
        curve = (design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        at = at - np.linalg.solve(curve, gradient)
    return float(at[0]), float(at[1])


def fit(texts: list[bytes], labels: list[int], *, penalty: float = 1e-3, rounds: int = 150) -> Model:
    labels_array = np.array(labels, np.int64)
    base = float(labels_array.mean()) if len(labels) else 0.5
    split = [lines_of(t) for t in texts]
    keep = [i for i, lines in enumerate(split) if lines]
    if len(set(labels_array[keep].tolist())) < 2:
        width = 3 * N_FEATURES + 1
        flat = float(np.log((base + 1e-6) / (1 - base + 1e-6)))
        return Model(np.zeros(width), np.zeros((2, 2)), 0.0, flat, base)
    counts = np.array([len(split[i]) for i in keep], np.int64)
    first = np.zeros(counts.sum(), bool)
    first[counts.cumsum() - counts] = True
    rows = chain_features(line_features([x for i in keep for x in split[i]]), first)
    weights, transition = fit_chain(rows, np.repeat(labels_array[keep], counts), counts, penalty=penalty, rounds=rounds)
    model = Model(weights, transition, 1.0, 0.0, base)
    raw = model.raw([texts[i] for i in keep])
    model.slope, model.offset = fit_curve(raw, labels_array[keep])
    return model


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_docs: int = 2000,
    longest: int = 16 * 1024,
    folds: int = 5,
    seed: int = 1,
) -> Model:
    """Fit on about ``sample_docs`` labelled documents of the training folds.

    The sample is bounded: documents of more than ``longest`` bytes are not
    trained on, though scored like all others. Only this sample reaches the
    driver. Labels of one document that contradict each other are all used.
    """
    known = labels.filter(F.col("quality").isNotNull() & (remainder("doc_id", folds) != 0))
    known = known.select(F.col("doc_id").alias("labelled"), F.col("quality").cast("int").alias("quality"))
    n = known.count()
    chosen = known.sample(min(1.0, sample_docs / n), seed=seed) if n else known
    texts = docs.select(F.col(id_col).alias("id"), raw_text(text_col).alias("text")).filter(F.octet_length("text") <= longest)
    rows = texts.join(chosen, F.col("id") == F.col("labelled")).select("id", "text", "quality").collect()
    rows.sort(key=lambda r: (r.id, r.quality, r.text))
    return fit([bytes(r.text) for r in rows], [int(r.quality == 1) for r in rows])


def scorer(model: Model):
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out, run, held = [], [], 0
            for text in texts:
                if run and held + len(text) > BYTES_AT_ONCE:
                    out.append(model.score(run))
                    run, held = [], 0
                run.append(text)
                held += len(text)
            if run:
                out.append(model.score(run))
            yield pd.Series(np.concatenate(out) if out else np.empty(0))

    return score


def score_documents(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, **how) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, **how)
    rows = docs.select(F.col(id_col).alias("doc_id"), scorer(model)(raw_text(text_col)).alias("score"))
    return rows.select(
        "doc_id",
        F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, **how) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, **how)
    name = free_name(docs, "_score")
    return docs.withColumn(name, scorer(model)(raw_text(text_col))).filter(F.col(name) >= threshold).drop(name)


def op7_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents."""
    return score_documents(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
