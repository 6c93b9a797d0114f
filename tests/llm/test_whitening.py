"""Whitening against an eigendecomposition of the exact covariance."""

import math

import numpy as np
import pytest

from tallyspark.llm import whitening
from tallyspark.llm.queries import QUERIES
from tests.llm.data import read
from tests.llm.test_queries import FOLDER

SCHEMA = "vec_id long, embedding array<float>, x string, whitened string"


def frame(spark, vectors, kind="float"):
    return spark.createDataFrame([(i, v, "theirs", "theirs") for i, v in enumerate(vectors)], SCHEMA.replace("float", kind))


def exact(x):
    """n, deviations and covariance in whole numbers."""
    x = [[int(c) for c in row] for row in x]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = np.array([[n * c - s for c, s in zip(row, sums)] for row in x], object)
    return n, [int(v) for v in (centred * centred).sum(axis=1)], centred.astype(float) / n


def test_query_matches_the_covariance(spark):
    table = read(spark, FOLDER, "embeddings").collect()
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in r.embedding] for r in table]
    n, deviations, centred = exact(x)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    want = centred @ axes[:, :32] / np.sqrt(values[:32])
    rows = QUERIES["op13_shifted_cholesky_whitening"](spark, FOLDER).collect()
    assert len(rows) == 32 * n and {r.n for r in rows} == {n} and len({r.identity_error for r in rows}) == 1
    assert rows[0].identity_error < 1e-9
    place = {r.vec_id: i for i, r in enumerate(table)}
    got = np.zeros((n, 32))
    for r in rows:
        got[place[r.vec_id], r.component - 1] = r.whitened
        assert r.deviation == deviations[place[r.vec_id]]
        assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9
    assert np.abs(got * np.sign((got * want).sum(axis=0)) - want).max() < 1e-7


def test_unusable_vectors_are_left_out(spark):
    good = [[float(i % 7), float(i % 3), float(i)] for i in range(20)]
    bad = [None, [None, 1.0, 2.0], [math.nan, 1.0, 2.0], [math.inf, 0.0, 0.0], [1.0, 2.0], [], [1e38, 0.0, 0.0]]
    whitened, fitted = whitening.whitened_embeddings(frame(spark, [*good, *bad]))
    rows = whitened.collect()
    assert sorted(r.vec_id for r in rows) == list(range(20)) and fitted.centre.n == 20
    assert whitened.columns == ["vec_id", "deviation", "whitened"]
    n, deviations, _ = exact([[math.floor(64 * c) + 1_000_000 for c in v] for v in good])
    assert {r.vec_id: r.deviation for r in rows} == dict(enumerate(deviations))
    assert np.abs(np.cov(np.array([r.whitened for r in rows]).T, bias=True) - np.eye(3)).max() < 1e-9


def test_dependent_constant_and_repeated(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 3))
    rows = np.column_stack([base, base[:, 0], np.full(300, 4.0), base[:, 1]])
    rows = np.concatenate([rows, rows[:50]]).tolist()
    whitened, fitted = whitening.whitened_embeddings(frame(spark, rows))
    assert fitted.components.shape == (6, 3) and fitted.identity_error < 1e-9
    assert abs(fitted.explained.sum() - 1) < 1e-9
    assert len(whitened.collect()) == 350
    for same in ([[1.0, 2.0]] * 5, [[1.0, 2.0]]):
        found, fitted = whitening.whitened_embeddings(frame(spark, same))
        assert [(r.deviation, r.whitened) for r in found.collect()] == [(0, [])] * len(same)
    found, fitted = whitening.whitened_embeddings(frame(spark, []))
    assert fitted is None and found.count() == 0 and found.columns == ["vec_id", "deviation", "whitened"]


def test_shifted_passes_recover_an_ill_conditioned_matrix(spark):
    """A condition of 10 ** 6 squares to 10 ** 12: one Cholesky factor of it alone loses what three keep."""
    rng = np.random.default_rng(2)
    rows = (rng.normal(size=(2000, 5)) * [1e7, 1e5, 1e4, 1e3, 1e1]) @ np.linalg.qr(rng.normal(size=(5, 5)))[0]
    x = np.floor(64 * rows) + 1_000_000
    n, deviations, centred = exact(x)
    whitened, fitted = whitening.whitened_embeddings(frame(spark, rows.tolist(), "double"))
    assert fitted.identity_error < 1e-6
    values = np.linalg.svd(centred, compute_uv=False) ** 2 / n
    assert np.abs(fitted.eigenvalues / values - 1).max() < 1e-6
    got = {r.vec_id: r.deviation for r in whitened.collect()}
    assert got == dict(enumerate(deviations))


def test_whole_numbers_beyond_64_bits():
    sums, n = [10 ** 15 * 10 ** 9, 3], 10 ** 9
    centre = whitening.Centre(n, sums)
    x = np.array([[10 ** 15 + 10 ** 11, 1], [10 ** 15, 0]])
    assert centre.scaled(x).tolist() == [[n * 10 ** 11, n - 3], [0, -3]]
    assert centre.deviation(x)[0] == (n * 10 ** 11) ** 2 + (n - 3) ** 2
    with pytest.raises(OverflowError):
        np.array(centre.deviation(x), np.int64)
