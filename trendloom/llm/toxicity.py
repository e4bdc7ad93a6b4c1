"""Toxic texts by a linear model over character n-grams scaled by naive Bayes log-count ratios.

Which n-grams (3 to 5 characters, by a 64-bit hash) a text contains is all that counts. For every n-gram the labelled texts
give the log of the ratio between its rates in toxic and other texts; those ratios scale the features of a
logistic regression. N-grams whose ratio stands ``LEAST_Z`` standard errors from zero become features, however many they are.

Counts cover all labelled training texts and are summed on the cluster. The regression is fitted on about ``FIT_ROWS`` of those
texts, in one task, which sees the numbers of their features and not the texts; the driver holds one weight for each feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendloom.llm import common
from trendloom.llm.common import held_out, labelled_sample, ship_package, stage

FOLDS, HELD_OUT_FOLD = 5, 0
ORDERS = (3, 4, 5)
FIT_ROWS = 20_000
LEAST_Z = 4.0
RIDGE = 1e-4
STEPS = 200
TOLERANCE = 1e-7
THRESHOLD = 0.5
#: Labelled ids up to this many (16 bytes each) are broadcast; beyond it texts and labels are shuffled to meet.
BROADCAST_IDS = 2_000_000

_PIECE = 1 << 20
_HELD = 1 << 22
_ENTRIES = 1 << 20
_MEMORY = 10
_TABLE_BITS = 21
_BASE, _SPREAD = np.uint64(1_000_003), np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(text: str, likely: np.ndarray | None = None) -> np.ndarray:
    """Distinct hashes of the character n-grams of a text, in order; with ``likely``, only those whose top bits it marks.

    Long texts are read in pieces that overlap, so no n-gram is lost.
    """
    found, padded = [], f" {text.lower()} "
    for at in range(0, len(padded), _PIECE):
        piece = padded[at : at + _PIECE + max(ORDERS) - 1].encode("utf-32-le", "replace")
        code = np.frombuffer(piece, np.uint32).astype(np.uint64)
        h, own = code, []
        for order in range(2, max(ORDERS) + 1):
            if len(h) < 2:
                break
            h = h[:-1] * _BASE + code[order - 1 :]
            if order in ORDERS:
                mixed = h * _SPREAD
                if likely is not None:
                    mixed = mixed[likely[mixed >> np.uint64(64 - _TABLE_BITS)]]
                own.append(mixed)
        if own:
            found.append(np.unique(np.concatenate(own)))
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def marked_tops(hashes: np.ndarray) -> np.ndarray:
    """Which top bits occur; most n-grams of a text are told apart from the features by it."""
    table = np.zeros(1 << _TABLE_BITS, bool)
    table[hashes >> np.uint64(64 - _TABLE_BITS)] = True
    return table


def places(hashes: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Where in the sorted features those of the hashes are that belong to them."""
    if not len(features):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(features, hashes), len(features) - 1)
    return at[features[at] == hashes]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, pos, neg): how many texts of each label have an n-gram, in parts that still have to be added up."""
    held: tuple[list, list] = ([], [])
    size = 0

    def passed_on() -> pa.RecordBatch:
        kinds = [np.unique(np.concatenate(h), return_counts=True) if h else (np.zeros(0, np.uint64), np.zeros(0, np.int64)) for h in held]
        grams = np.concatenate([g for g, _ in kinds]).view(np.int64)
        numbers = [np.concatenate([n if i == k else np.zeros_like(n) for k, (_, n) in enumerate(kinds)]) for i in (1, 0)]
        for h in held:
            h.clear()
        return pa.RecordBatch.from_arrays([pa.array(grams), *map(pa.array, numbers)], ["gram", "pos", "neg"])

    for batch in (part for whole in batches for part in common.slices(whole)):
        for text, y in zip(batch.column("text"), batch.column("y").to_pylist()):
            found = gram_hashes(text.as_py())
            held[int(y > 0)].append(found)
            size += len(found)
        if size > _HELD:
            yield passed_on()
            size = 0
    yield passed_on()


def _feature_lists(features: np.ndarray):
    """y and the numbers of the features that a text has, as bytes of int32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        likely = marked_tops(features)
        for batch in (part for whole in batches for part in common.slices(whole)):
            rows = [places(gram_hashes(t.as_py(), likely), features).astype(np.int32).tobytes() for t in batch.column("text")]
            y = pa.array([float(v > 0) for v in batch.column("y").to_pylist()])
            yield pa.RecordBatch.from_arrays([y, pa.array(rows, pa.binary())], ["label", "grams"])

    return run


class Loss:
    """Mean logistic loss of rows of features, with the ridge, and its slope.

    A row is a list of numbers of features; its values are the ratios of those. One more column, last, is the bias, which has no ridge
    and stands in every row, so that no row is empty. Rows are taken in blocks of about ``_ENTRIES`` entries.
    """

    def __init__(self, y: np.ndarray, rows: list[np.ndarray], ratio: np.ndarray) -> None:
        self.n, self.scale, self.ridge = len(y), np.r_[ratio, 1.0], np.r_[np.full(len(ratio), RIDGE), 0.0]
        bias = np.array([len(ratio)], np.int32)
        ends = np.cumsum([len(r) + 1 for r in rows])
        cuts = np.unique(np.searchsorted(ends, np.arange(_ENTRIES, ends[-1] + _ENTRIES, _ENTRIES), "right").clip(1, len(rows)))
        self.blocks = []
        for low, high in zip([0, *cuts[:-1].tolist()], cuts.tolist()):
            sizes = np.array([len(r) + 1 for r in rows[low:high]])
            self.blocks.append((y[low:high], np.concatenate([part for r in rows[low:high] for part in (r, bias)]), sizes))

    def __call__(self, weights: np.ndarray) -> tuple[float, np.ndarray]:
        loss, slope, scaled = 0.0, np.zeros(len(weights)), weights * self.scale
        for y, columns, sizes in self.blocks:
            logit = np.add.reduceat(scaled[columns], np.cumsum(sizes) - sizes)
            loss += float((np.logaddexp(0, logit) - y * logit).sum())
            off = 1 / (1 + np.exp(-np.clip(logit, -500, 500))) - y
            slope += np.bincount(columns, np.repeat(off, sizes), len(weights))
        return loss / self.n + float(self.ridge @ weights**2) / 2, slope * self.scale / self.n + self.ridge * weights


def least_point(loss: Loss, size: int) -> np.ndarray:
    """Where a smooth convex function is least, by steps along its slope bent by the last ``_MEMORY`` changes (L-BFGS)."""
    at = np.zeros(size)
    value, slope = loss(at)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(STEPS):
        if np.abs(slope).max() <= TOLERANCE:
            break
        way, used = -slope, []
        for moved, turned, inverse in reversed(past):
            share = inverse * float(moved @ way)
            way = way - share * turned
            used.append(share)
        if past:
            moved, turned, _ = past[-1]
            way = way * float(moved @ turned) / float(turned @ turned)
        for (moved, turned, inverse), share in zip(past, reversed(used)):
            way = way + (share - inverse * float(turned @ way)) * moved
        length, fall = 1.0 if past else 1 / max(1.0, float(np.abs(slope).sum())), float(slope @ way)
        while True:
            new_value, new_slope = loss(at + length * way)
            if new_value <= value + 1e-4 * length * fall or length < 1e-12:
                break
            length /= 2
        moved, turned = length * way, new_slope - slope
        if float(moved @ turned) <= 0:
            break
        past = [*past, (moved, turned, 1 / float(moved @ turned))][-_MEMORY:]
        at, value, slope = at + moved, new_value, new_slope
    return at


def _fit(ratio: np.ndarray):
    """One row: the fitted weights, the bias last. The rows are put in order, so that sums do not depend on how they arrive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((y, grams) for batch in batches for y, grams in zip(batch.column("label").to_pylist(), batch.column("grams").to_pylist()))
        if rows:
            loss = Loss(np.array([y for y, _ in rows]), [np.frombuffer(g, np.int32) for _, g in rows], ratio)
            found = least_point(loss, len(ratio) + 1)
            yield pa.RecordBatch.from_arrays([pa.array([found.tobytes()], pa.binary())], ["weights"])

    return run


@dataclass
class Model:
    """Sorted hashes of the features, the weight that each adds, and the bias."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.likely = marked_tops(self.features)

    def score(self, text: str) -> float:
        logit = self.bias + float(self.weights[places(gram_hashes(text, self.likely), self.features)].sum())
        return float(1 / (1 + np.exp(-np.clip(logit, -500, 500))))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, y) of all labelled documents outside the held-out fold; of labels that disagree on an id the larger holds."""
    ids = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(FOLDS, HELD_OUT_FOLD))
    ids = ids.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("y"))
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(ids, "id").select("text", "y")


def log_count_ratios(rows: DataFrame, pos: int, neg: int) -> DataFrame:
    """(gram, ratio, z) of all n-grams of (text, y), of which pos and neg texts have either label."""
    counts = rows.mapInArrow(_counts, "gram long, pos long, neg long").groupBy("gram").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    rate = lambda c, n: F.log((F.col(c) + 1) / F.lit(n + 2))
    error = F.sqrt(1 / (F.col("pos") + 1) + 1 / (F.col("neg") + 1))
    return counts.withColumn("ratio", rate("pos", pos) - rate("neg", neg)).select("gram", "ratio", (F.abs("ratio") / error).alias("z"))


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Learn from labelled texts outside the held-out fold. Without labels of both kinds every score is that of the one kind, zero without any."""
    ship_package(docs.sparkSession)
    rows = labelled(docs, labels)
    pos, neg = rows.agg(F.count_if(F.col("y") > 0), F.count_if(F.col("y") <= 0)).first()
    none = np.zeros(0, np.uint64)
    if not pos or not neg:
        return Model(none, np.zeros(0), 500.0 if pos else -500.0)
    chosen = log_count_ratios(rows, pos, neg).where(F.col("z") >= LEAST_Z).select("gram", "ratio").toArrow()
    features, ratio = chosen.column("gram").to_numpy().view(np.uint64), chosen.column("ratio").to_numpy()
    order = np.argsort(features)
    features, ratio = features[order], ratio[order]
    sample = labelled_sample(docs, labels, "toxic", FOLDS, HELD_OUT_FOLD, fit_rows)
    lists = stage(sample.mapInArrow(_feature_lists(features), "label double, grams binary"), "toxicity-features")
    kinds = lists.agg(F.min("label"), F.max("label")).first()
    if not len(features) or kinds[0] == kinds[1]:
        return Model(none, np.zeros(0), float(np.log(pos / neg)))
    # The lists are bounded by fit_rows.
    fitted = np.frombuffer(lists.coalesce(1).mapInArrow(_fit(ratio), "weights binary").first().weights)
    common.discard(docs.sparkSession, common.folder_of(lists))
    return Model(features, fitted[:-1] * ratio, float(fitted[-1]))


def score_column(docs: DataFrame, model: Model) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def score(text: pa.Array) -> pa.Array:
        return pa.array([shared.value.score(t.as_py() or "") for t in text], pa.float64())

    return score(F.col("text").cast("string"))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Null texts score as empty ones; both get the score that the model gives to no evidence. Texts count whole, however long. Repeated rows get
    the same score, null ids count as not held out. An empty table gives no rows. Further columns are ignored.
    """
    score = docs.select("doc_id", held_out(FOLDS, HELD_OUT_FOLD).alias("held_out"), score_column(docs, train(docs, labels)).alias("score"))
    return score.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that are predicted toxic; all columns and all other rows stay as they are.

    Null and empty texts stay unless nearly all labels are toxic. An empty table gives an empty one; no column is added, so none can clash.
    """
    return docs.where(score_column(docs, train(docs, labels)) < THRESHOLD)
