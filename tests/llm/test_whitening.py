import numpy as np
import pytest

from trendloom.llm import whitening
from trendloom.llm.queries import op11_whitening


def plain(vectors: list, weights: str = "one") -> tuple:
    """Distinct integer vectors, their weighted sums and covariance, without Spark."""
    x = np.floor(np.array(vectors, dtype=np.float64) * 256).astype(np.int64)
    distinct, counts = np.unique(x, axis=0, return_counts=True)
    w = counts if weights == "copies" else np.ones(len(distinct), np.int64)
    n, sums = int(w.sum()), w @ distinct
    centred = distinct - sums / n
    return x, n, sums, (centred * w[:, None]).T @ centred / n


def check(rows, ids, vectors, weights="one"):
    x, n, sums, covariance = plain(vectors, weights)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(4, x.shape[1])
    assert len(rows) == len(ids) * k
    deviation = {i: sum((n * int(c) - int(s)) ** 2 for c, s in zip(v, sums)) for i, v in zip(ids, x)}
    want = ((x - sums / n) @ axes[:, :k]) / np.sqrt(values[:k])
    place = {i: r for r, i in enumerate(ids)}
    for c in range(k):
        own = [r for r in rows if r.component == c + 1]
        assert {r.explained for r in own} == {own[0].explained} and own[0].explained == pytest.approx(values[c] / np.trace(covariance), rel=1e-9)
        got = np.array([r.whitened for r in own])
        expected = np.array([want[place[r.vec_id], c] for r in own])
        assert min(np.abs(got - expected).max(), np.abs(got + expected).max()) < 1e-6
        assert all(r.n == n and r.deviation == deviation[r.vec_id] for r in own)
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9


def test_given_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    check(op11_whitening(spark, sf_dir).collect(), [r.vec_id for r in table], [r.embedding for r in table])


@pytest.mark.parametrize("weights", whitening.WEIGHTS)
def test_copies(spark, weights):
    """A vector in half of all rows: one of the fit list, or as many as it has copies; its rows are dealt to several places."""
    rnd = np.random.default_rng(5)
    own = rnd.normal(size=(150, 6)) * [3, 2, 1.5, 1, 0.5, 0.1]
    vectors = [*own.tolist(), *[own[0].tolist()] * 150, *(own[1:20] + 1e-9).tolist()]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    check(whitening.whiten(df, weights=weights).collect(), list(range(len(vectors))), vectors, weights)


def test_odd_vectors(spark):
    rows = [
        (1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 1.0]), (2, [-0.0, 0.5]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]),
        (6, [float("-inf"), 1.0]), (7, []), (8, [1.0, 2.0, 3.0]), (9, [-0.001, 0.499]),
    ]
    df = spark.createDataFrame([(i, v, "x", 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, x string, copies int, whitened double")
    got = whitening.whiten(df).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == [(i, c) for i in (0, 1, 2, 9) for c in (1, 2) for _ in range(1 + (i == 1))]
    assert {r.n for r in got} == {4} and all(r.whitened is not None for r in got) and got[0].identity_error < 1e-9
    assert whitening.whiten(df.where("false")).count() == 0 and whitening.whiten(df.where("vec_id in (3, 7)")).count() == 0


def test_no_variance_and_huge_entries(spark):
    flat = spark.createDataFrame([(i, [1.0, 2.0, 3.0]) for i in range(5)], "vec_id long, embedding array<double>")
    got = whitening.whiten(flat).collect()
    assert len(got) == 15 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(1, 0, None, None, None)}
    line = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(5)], "vec_id long, embedding array<double>")
    got = whitening.whiten(line).collect()
    assert {(r.component, r.whitened is None, round(r.explained, 9)) for r in got} == {(1, False, 1.0), (2, True, 0.0)}
    huge = spark.createDataFrame([(1, [1e12, 0.0]), (2, [1.0, 1.0]), (3, [1e300, 0.0])], "vec_id long, embedding array<double>")
    assert {(r.vec_id, r.deviation is None) for r in whitening.whiten(huge).collect()} >= {(3, True)}
