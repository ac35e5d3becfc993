"""Quality classifier: an additive model with pairwise interactions.

Every count of a text is binned; the model is one lookup table per feature, a
few tables per pair of features, and an intercept, summed and squashed. The
tables are learnt by cyclic boosting: in each round every feature in turn gets
a shallow tree over its bins, fitted to the current log-loss gradient and added
with a small rate. Pairs are ranked by how much a tree of two crossing cuts
would gain on what the single features leave over; the best few are boosted the
same way. Scoring is bin look-ups and additions over whole batches.

Only the fit is bounded: it takes the ``sample`` labelled rows with the smallest
hash. Every document is scored, from its whole text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from movecheck.llm.text import text_counts

FEATURES = (
    "word_length", "symbols", "dup_lines", "repeats", "upper", "digits", "marks",
    "distinct", "words", "line_length",
)
SAMPLE = 20_000
BINS = 48
ROUNDS = 160
PAIRS = 6
PAIR_BINS = 12
PAIR_ROUNDS = 60
RATE = 0.1
RIDGE = 2.0


def features(text: str | None) -> list[float]:
    c = text_counts(text)
    words, chars, lines = max(c["n_words"], 1), max(c["word_chars"], 1), max(c["n_lines"], 1)
    return [
        chars / words,
        c["n_symbols"] / words,
        c["n_dup_lines"] / lines,
        c["n_repeat_words"] / words,
        c["n_upper"] / chars,
        c["n_digits"] / chars,
        c["n_marks"] / words,
        c["n_distinct"] / words,
        math.log1p(c["n_words"]),
        math.log1p(c["n_words"] / lines),
    ]


@dataclass
class AdditiveModel:
    """Cuts per feature, tables per feature and per pair, and an intercept."""

    intercept: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pair_cuts: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            total += table[np.searchsorted(cuts, x[:, j], side="right")]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            rows = np.searchsorted(self.pair_cuts[i], x[:, i], side="right")
            columns = np.searchsorted(self.pair_cuts[j], x[:, j], side="right")
            total += table[rows, columns]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def quantile_cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + RIDGE)


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """(gain, bins on the left) of the best cut of a histogram, or (0, 0)."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl) - _gain(g.sum(), h.sum())
    at = int(np.argmax(gains))
    return (float(gains[at]), at + 1) if gains[at] > 1e-9 else (0.0, 0)


def shallow_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf values, per bin, of a tree of ``depth`` levels over the bins."""
    _, at = best_cut(g, h) if depth else (0.0, 0)
    if not at:
        return np.full(len(g), float(_leaf(g.sum(), h.sum())))
    return np.concatenate(
        [shallow_tree(g[:at], h[:at], depth - 1), shallow_tree(g[at:], h[at:], depth - 1)]
    )


def crossed_cuts(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best pair of crossing cuts of a 2-d histogram: its gain and leaf values."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    total_g, total_h = cg[-1, -1], ch[-1, -1]
    a_g, a_h = cg[:-1, :-1], ch[:-1, :-1]
    b_g, b_h = cg[:-1, -1:] - a_g, ch[:-1, -1:] - a_h
    c_g, c_h = cg[-1:, :-1] - a_g, ch[-1:, :-1] - a_h
    d_g, d_h = total_g - a_g - b_g - c_g, total_h - a_h - b_h - c_h
    if not a_g.size:
        return 0.0, np.zeros_like(g)
    gains = _gain(a_g, a_h) + _gain(b_g, b_h) + _gain(c_g, c_h) + _gain(d_g, d_h)
    r, c = np.unravel_index(int(np.argmax(gains)), gains.shape)
    leaves = np.empty_like(g)
    leaves[: r + 1, : c + 1] = _leaf(a_g[r, c], a_h[r, c])
    leaves[: r + 1, c + 1 :] = _leaf(b_g[r, c], b_h[r, c])
    leaves[r + 1 :, : c + 1] = _leaf(c_g[r, c], c_h[r, c])
    leaves[r + 1 :, c + 1 :] = _leaf(d_g[r, c], d_h[r, c])
    return float(gains[r, c] - _gain(total_g, total_h)), leaves


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """The model for features x (rows, features) and labels y of 0 and 1.

    Without rows it scores 0.5 everywhere; with one class only, a smoothed rate.
    """
    rate = (float(y.sum()) + 1) / (len(y) + 2)
    intercept = math.log(rate / (1 - rate))
    d = len(FEATURES)
    none = [np.zeros(0)] * d
    if not len(y) or y.min() == y.max():
        return AdditiveModel(intercept, none, [np.zeros(1)] * d, none, [], [])
    cuts = [quantile_cuts(x[:, j], BINS) for j in range(d)]
    bins = [np.searchsorted(cuts[j], x[:, j], side="right") for j in range(d)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    total = np.full(len(y), intercept)

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(d):
            g, h = gradients()
            n = len(tables[j])
            step = RATE * shallow_tree(np.bincount(bins[j], g, n), np.bincount(bins[j], h, n))
            tables[j] += step
            total += step[bins[j]]

    pair_cuts = [quantile_cuts(x[:, j], PAIR_BINS) for j in range(d)]
    coarse = [np.searchsorted(pair_cuts[j], x[:, j], side="right") for j in range(d)]

    def histograms(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = len(pair_cuts[i]) + 1, len(pair_cuts[j]) + 1
        cells = coarse[i] * shape[1] + coarse[j]
        size = shape[0] * shape[1]
        g, h = gradients()
        return (
            np.bincount(cells, g, size).reshape(shape), np.bincount(cells, h, size).reshape(shape), cells
        )

    ranked = sorted(
        combinations(range(d), 2), key=lambda p: (-crossed_cuts(*histograms(*p)[:2])[0], p)
    )
    pairs = ranked[:PAIRS]
    pair_tables = [np.zeros((len(pair_cuts[i]) + 1, len(pair_cuts[j]) + 1)) for i, j in pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (i, j) in enumerate(pairs):
            g, h, cells = histograms(i, j)
            step = RATE * crossed_cuts(g, h)[1]
            pair_tables[k] += step
            total += step.ravel()[cells]
    return AdditiveModel(intercept, cuts, tables, pair_cuts, pairs, pair_tables)


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id's text, modulo; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % divisor


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [features(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"]
        )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> AdditiveModel:
    """Fit on the sample of labels whose remainder modulo 3 is not 1."""
    usable = labels.filter(
        F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder("doc_id", 3) != 1)
    ).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # At most ``sample`` rows of two numbers, whatever the tables hold.
    found = docs.select("doc_id", "text").join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")
    vectors = found.mapInArrow(_featurize, "doc_id long, x array<double>")
    one_each = vectors.groupBy("doc_id").agg(F.min("x").alias("x"))
    rows = one_each.join(chosen, "doc_id").orderBy("doc_id").select("x", "quality").toPandas()
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES))
    return fit(x, rows["quality"].to_numpy(float))


def score(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on)."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(1)], float)
            values = model.score(x.reshape(batch.num_rows, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["doc_id", "score"])

    out = docs.select("doc_id", "text").mapInArrow(scored, "doc_id long, score double")
    return out.select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def classify_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Train on the labelled rows, then score every document.

    Null and empty texts are scored as texts without words. Labels other than 0
    and 1, or without a doc_id, are ignored; of several labels of one document
    the smallest counts. Equal rows each get a score. Of docs only doc_id and
    text are read.
    """
    return score(docs, train(docs, labels, sample))
