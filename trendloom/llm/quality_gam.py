"""Quality of a text by a generalised additive model with pairwise interactions.

A text is described by a few numbers (``FEATURES``), each cut into bins at quantiles. The model is a sum of lookup
tables: one per feature, and one per chosen pair of features over coarser bins. The tables are learned by cyclic
boosting: features take turns, and each turn adds a shrunken shallow tree over the bins of that feature, fitted to what
the model so far leaves over. Pairs are chosen by what a tree over both could still gain, and take turns afterwards.
A score is a sum of table entries, looked up for a whole batch of texts at once.

Fitting sees the numbers, not the texts, of at most about ``FIT_ROWS`` labelled rows, on the driver.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.llm import common
from trendloom.llm.common import held_out, labelled_sample, ship_package

FOLDS, HELD_OUT_FOLD = 5, 0
FIT_ROWS = 40_000
THRESHOLD = 0.3
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 60, 30, 6
DEPTH, RATE, RIDGE = 2, 0.15, 5.0

FEATURES = (
    "words", "word_length", "longest_word", "upper", "digits", "symbols", "exclamations", "stops", "breaks",
    "non_ascii", "distinct_words", "top_word", "repeated_lines", "byte_entropy", "capital_words",
)
_SYMBOLS, _STOPS = list(b"#*$%&|<>"), list(b".,;:?")


def features(text: bytes) -> list[float]:
    """The numbers that describe a text; those of an empty text are 0."""
    if not text:
        return [0.0] * len(FEATURES)
    bytes_ = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size, n, letters, longest, capitals, counts = len(text), 0, 0, 0, 0, Counter()
    for words in common.word_lists(text):
        counts.update(words)
    for word, times in counts.items():
        n += times
        letters += times * len(word)
        longest = max(longest, len(word))
    lines = [x for x in text.split(b"\n") if x.strip()]
    ascii_letters = max(int(bytes_[65:91].sum() + bytes_[97:123].sum()), 1)
    share = bytes_[bytes_ > 0] / size
    return [
        np.log1p(n), letters / max(n, 1), np.log1p(longest), bytes_[65:91].sum() / ascii_letters, bytes_[48:58].sum() / size,
        bytes_[_SYMBOLS].sum() / size, bytes_[33] / size, bytes_[_STOPS].sum() / max(n, 1), bytes_[10] / max(n, 1),
        bytes_[128:].sum() / size, len(counts) / max(n, 1), max(counts.values(), default=0) / max(n, 1),
        1 - len(set(lines)) / max(len(lines), 1), float(-(share * np.log2(share)).sum()), bytes_[65:91].sum() / max(n, 1),
    ]


def grow(gradient: np.ndarray, weight: np.ndarray, depth: int) -> np.ndarray:
    """A table the shape of the histograms, constant on the leaves of a tree that splits bins, best gain first."""

    def worth(g, h):
        return g * g / (h + RIDGE)

    g, h = gradient.sum(), weight.sum()
    best, split = 1e-9, None
    for axis in range(gradient.ndim) if depth else ():
        other = tuple(a for a in range(gradient.ndim) if a != axis)
        gs, hs = np.cumsum(gradient.sum(axis=other))[:-1], np.cumsum(weight.sum(axis=other))[:-1]
        gain = worth(gs, hs) + worth(g - gs, h - hs) - worth(g, h)
        if len(gain) and gain.max() > best:
            best, split = gain.max(), (axis, int(gain.argmax()) + 1)
    if split is None:
        return np.full(gradient.shape, g / (h + RIDGE))
    axis, cut = split
    halves = zip(np.split(gradient, [cut], axis), np.split(weight, [cut], axis))
    return np.concatenate([grow(a, b, depth - 1) for a, b in halves], axis)


def _gain(gradient: np.ndarray, weight: np.ndarray, depth: int) -> float:
    table = grow(gradient, weight, depth)
    return float((table * gradient).sum())


@dataclass
class Model:
    base: float
    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Of a batch, one row of features each: bin, look up, add."""
        logit = np.full(len(x), self.base)
        coarse = []
        for j, table in enumerate(self.tables):
            b = np.searchsorted(self.edges[j], x[:, j], "right")
            coarse.append(self.coarse[j][b])
            logit += table[b]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            logit += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of features, then of pairs. Without labels of both kinds every score is the share of 1s."""
    width = len(FEATURES)
    share = np.clip(y.mean() if len(y) else 0.0, 0, 1)
    if share in (0.0, 1.0):
        return Model(500.0 if share else -500.0, [np.zeros(0)] * width, [np.zeros(1, int)] * width, [np.zeros(1)] * width, [], [])
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    bins = [np.searchsorted(edges[j], x[:, j], "right") for j in range(width)]
    coarse = [np.arange(len(e) + 1) * PAIR_BINS // (len(e) + 1) for e in edges]
    logit = np.full(len(y), base := float(np.log(share / (1 - share))))

    def histograms(index: np.ndarray, shape: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-logit))
        size = int(np.prod(shape))
        return (np.bincount(index, v, size).reshape(shape) for v in (y - p, p * (1 - p)))

    tables = [np.zeros(len(e) + 1) for e in edges]
    for _ in range(ROUNDS):
        for j, table in enumerate(tables):
            step = RATE * grow(*histograms(bins[j], table.shape), DEPTH)
            table += step
            logit += step[bins[j]]
    shape = (PAIR_BINS, PAIR_BINS)
    index = {(i, j): coarse[i][bins[i]] * PAIR_BINS + coarse[j][bins[j]] for i, j in combinations(range(width), 2)}
    pairs = sorted(sorted(index, key=lambda p: -_gain(*histograms(index[p], shape), DEPTH))[:PAIRS])
    pair_tables = [np.zeros(shape) for _ in pairs]
    for _ in range(PAIR_ROUNDS):
        for pair, table in zip(pairs, pair_tables):
            step = RATE * grow(*histograms(index[pair], shape), DEPTH)
            table += step
            logit += step.ravel()[index[pair]]
    return Model(base, edges, coarse, tables, pairs, pair_tables)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t) for t in common.texts(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(rows, pa.list_(pa.float64()))], ["y", "x"])


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    ship_package(docs.sparkSession)
    sample = labelled_sample(docs, labels, "quality", FOLDS, HELD_OUT_FOLD, fit_rows)
    rows = sample.mapInArrow(_features, "y int, x array<double>").toArrow()
    x = np.array(rows.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    y = (rows.column("y").to_numpy() > 0).astype(float)
    order = np.lexsort((*x.T, y))
    return fit(x[order], y[order])


def score_column(docs: DataFrame, model: Model) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def score(text: pa.Array) -> pa.Array:
        x = np.array([features(t) for t in common.texts(text)], float).reshape(-1, len(FEATURES))
        return pa.array(shared.value.scores(x), pa.float64())

    return score(F.col("text").cast("string"))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Null texts score as empty ones, by the bins that hold zeros. Repeated rows get the same score, null ids count as
    not held out. An empty table gives no rows. Further columns are ignored.
    """
    score = docs.select("doc_id", held_out(FOLDS, HELD_OUT_FOLD).alias("held_out"), score_column(docs, train(docs, labels)).alias("score"))
    return score.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
