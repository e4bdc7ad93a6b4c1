"""Whitening of embeddings whose vectors repeat: statistics over distinct vectors, each whitened once and joined back.

1. Entries become integers, ``floor(scale * c)``. Equal vectors are grouped, partial groups first, so that a vector in a
   third of all rows is one row with a count. The distinct vectors are written to the shared folder.
2. One pass sums every dimension exactly. A second pass subtracts the mean and multiplies: each task adds up one matrix for
   all its vectors and gives its upper triangle, which Spark sums. A distinct vector weighs one, or as often as it occurs.
3. The driver takes the eigenvectors of that matrix, whose size depends on the dimensions alone.
4. Each distinct vector is projected once, and the rows fetch the result by their vector. Vectors with many rows
   are copied to as many places as their count asks for.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendloom.llm.common import ship_package, stage
from trendloom.operators.skew import salted_left_join

SCALE = 256
COMPONENTS = 4
WEIGHTS = ("one", "copies")

_SAFE = 1 << 62


@dataclass(frozen=True)
class Whitener:
    """n: sum of the weights; sums: exact sums by dimension; axes: unit eigenvectors as columns, largest variance first."""

    n: int
    sums: tuple[int, ...]
    mean: np.ndarray
    axes: np.ndarray
    variances: np.ndarray
    trace: float

    def explained(self) -> list[float | None]:
        return [float(v / self.trace) if self.trace > 0 else None for v in self.variances]

    def spreads(self) -> np.ndarray:
        """Which components have a variance beyond rounding; the others cannot be scaled to one."""
        return self.variances > len(self.sums) * np.finfo(float).eps * self.trace


def integer_vector(vector: str, scale: int = SCALE) -> Column:
    """floor(scale * c) of every entry, null where the vector is null or has an entry that is null or not finite.

    Entries beyond the range of a long become its nearest limit.
    """
    finite = F.forall(F.col(vector), lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    return F.when(finite, F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("long")))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _added(x: np.ndarray, w: np.ndarray) -> list[int]:
    """Weighted sums of the columns, exact."""
    largest = max(int(x.max()), -int(x.min()))
    if largest * sum(w.tolist()) < _SAFE:
        return (w @ x).tolist()
    return [sum(a * b for a, b in zip(column, w.tolist())) for column in x.T.tolist()]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(at, value): the sum of each dimension over the task, and at -1 the sum of the weights."""
    n, total = 0, None
    for batch in batches:
        if batch.num_rows:
            w = batch.column("w").to_numpy(zero_copy_only=False)
            part = _added(_matrix(batch.column("x")), w)
            total = part if total is None else [a + b for a, b in zip(total, part)]
            n += sum(w.tolist())
    if total is not None:
        values = pa.array([Decimal(v) for v in (n, *total)], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(total)), pa.int32()), values], ["at", "value"])


def _products(mean: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(i, j, value) with i <= j: weighted products of the centred entries, summed over the task."""
        total = None
        for batch in batches:
            if batch.num_rows:
                centred = _matrix(batch.column("x")) - mean
                part = (centred * batch.column("w").to_numpy(zero_copy_only=False)[:, None]).T @ centred
                total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(len(mean))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "value"])

    return run


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Fit on distinct vectors (x, w) of one length. None if there is nothing to fit.

    What reaches the driver is one number for each dimension and for each pair of dimensions.
    """
    sums = distinct.select("x", "w").mapInArrow(_sums, "at int, value decimal(38,0)").groupBy("at").agg(F.sum("value").alias("value"))
    got = {r.at: int(r.value) for r in sums.collect()}
    n, width = got.pop(-1, 0), len(got)
    if not width:
        return None
    total = tuple(got[i] for i in range(width))
    mean = np.array([s / n for s in total])
    pairs = distinct.select("x", "w").mapInArrow(_products(mean), "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    covariance = np.zeros((width, width))
    for r in pairs.collect():
        covariance[r.i, r.j] = covariance[r.j, r.i] = r.value / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    return Whitener(n, total, mean, vectors[:, order], values[order], float(np.trace(covariance)))


def _deviations(x: np.ndarray, fitted: Whitener) -> list[int | None]:
    """Sum over dimensions of (n*x - S)^2, exact; null where it is no long."""
    largest = fitted.n * max(int(x.max()), -int(x.min())) + max(abs(s) for s in fitted.sums)
    if largest * largest * x.shape[1] < _SAFE:
        apart = fitted.n * x - np.array(fitted.sums)
        return (apart * apart).sum(axis=1).tolist()
    exact = (sum((fitted.n * c - s) ** 2 for c, s in zip(row, fitted.sums)) for row in x.tolist())
    return [v if v < 1 << 63 else None for v in exact]


def _whitened(fitted: Whitener):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread = fitted.spreads()
        scale = np.sqrt(np.where(spread, fitted.variances, 1.0))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("x"))
            projected = ((x - fitted.mean) @ fitted.axes) / scale
            flat = pa.array(projected.ravel(), mask=np.tile(~spread, len(x)))
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * projected.shape[1])
            columns = [batch.column("x"), batch.column("copies"), batch.column("w"), pa.array(_deviations(x, fitted), pa.int64()), pa.ListArray.from_arrays(ends, flat)]
            yield pa.RecordBatch.from_arrays(columns, ["x", "copies", "w", "deviation", "whitened"])

    return run


def identity_error(whitened: DataFrame, fitted: Whitener) -> float | None:
    """Largest absolute entry of the covariance of the whitened distinct vectors minus the identity; components without variance are left out."""
    used = [int(k) for k in np.flatnonzero(fitted.spreads())]
    if not used:
        return None
    value = {k: F.col("whitened")[k] for k in used}
    means = whitened.agg(*[(F.sum(F.col("w") * value[k]) / fitted.n).alias(f"m{k}") for k in used]).first()
    centred = {k: value[k] - F.lit(means[f"m{k}"]) for k in used}
    pairs = [(i, j) for i in used for j in used if i <= j]
    found = whitened.agg(*[(F.sum(F.col("w") * centred[i] * centred[j]) / fitted.n).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS, weights: str = "one", scale: int = SCALE) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error of every row and component.

    ``weights`` says how a distinct vector counts in the fit: "one", or "copies", as often as it occurs. Null vectors and
    those with null or infinite entries give no rows, nor do vectors of another length than the most
    common one (of equally common lengths the larger). Repeated rows and repeated or null ids are rows of their own.
    A component without variance, as all are where there is one distinct vector, has whitened null and explained
    zero (null if no component has any); identity_error covers the others and is null if there are none. deviation is null
    where it does not fit in a long. Vectors shorter than ``components`` have fewer components; an empty
    table, or one of empty vectors, gives no rows. Further columns are ignored.
    """
    if weights not in WEIGHTS:
        raise ValueError(f"weights is one of {', '.join(WEIGHTS)}")
    spark = rows.sparkSession
    ship_package(spark)
    valid = rows.select(F.col("vec_id"), integer_vector(vector, scale).alias("x")).where("x is not null")
    distinct = stage(valid.groupBy("x").agg(F.count("*").alias("copies")), "vectors")
    lengths = distinct.groupBy(F.size("x").alias("length")).agg(F.sum("copies").alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    width = common.length if common else 0
    weighed = distinct.where(F.size("x") == width).withColumn("w", F.col("copies") if weights == "copies" else F.lit(1).cast("long"))
    fitted = fit(weighed, components) if width else None
    if fitted is None:
        return spark.createDataFrame([], f"{_id_of(rows)}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    once = stage(weighed.mapInArrow(_whitened(fitted), "x array<long>, copies long, w long, deviation long, whitened array<double>"), "whitened")
    error = identity_error(once, fitted)
    back = salted_left_join(valid.where(F.size("x") == width), once, "x", F.col("vec_id"), "copies")
    each = back.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*[F.lit(s).cast("double") for s in fitted.explained()])
    return each.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        shares[F.col("at")].alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def _id_of(rows: DataFrame) -> str:
    return f"vec_id {rows.schema['vec_id'].dataType.simpleString()}"
