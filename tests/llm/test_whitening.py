"""Whitening against numpy's own eigenvalues on whole numbers of any size."""

from __future__ import annotations

import numpy as np
import pytest

from tidemark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows):
    """n, sums, whole numbers, eigenvalues and vectors of usable rows."""
    x = np.array([np.floor(64 * np.float32(v).astype(np.float64)).astype(np.int64) + 1_000_000 for _, v in rows])
    mean = x.sum(axis=0) / len(x)
    values, vectors = np.linalg.eigh(np.cov((x - mean).T, bias=True).reshape(x.shape[1], -1))
    return x, mean, values[::-1], vectors[:, ::-1]


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("d", [1, 2, 5, 40])
def test_rotations_find_the_eigenvectors(d):
    rng = np.random.default_rng(d)
    q, _ = np.linalg.qr(rng.normal(size=(d, d)))
    wanted = 10.0 ** -np.arange(d) if d < 15 else np.sort(rng.random(d))[::-1]
    values, vectors = whitening.jacobi(q @ np.diag(wanted) @ q.T)
    assert np.allclose(values, wanted, rtol=1e-9, atol=1e-14)
    assert np.allclose(vectors.T @ vectors, np.eye(d), atol=1e-13)


def test_small_eigenvalues_of_a_scaled_matrix_are_accurate():
    rng = np.random.default_rng(3)
    base = np.cov(rng.normal(size=(6, 400)))
    scale = 10.0 ** -np.arange(0, 30, 5)
    values, _ = whitening.jacobi(base * scale[:, None] * scale)
    # The product of eigenvalues is the determinant, which scales exactly.
    assert np.isclose(np.log(values).sum(), np.log(np.linalg.det(base)) + 2 * np.log(scale).sum(), rtol=1e-12)


def test_every_pair_meets_once():
    for d in range(0, 9):
        pairs = [(int(a), int(b)) for p, q in whitening.rounds(d) for a, b in zip(p, q, strict=True)]
        assert sorted(pairs) == [(a, b) for a in range(d) for b in range(a + 1, d)]
        assert all(len({*p.tolist(), *q.tolist()}) == 2 * len(p) for p, q in whitening.rounds(d))


@pytest.mark.parametrize("d,components", [(3, 3), (40, 32)])
def test_rows_are_whitened(spark, d, components):
    rng = np.random.default_rng(d)
    rows = [(k, v) for k, v in enumerate((rng.normal(size=(300, d)) * (1 + np.arange(d)) / 3).astype(np.float32))]
    odd = [(900, None), (901, []), (902, [float("nan")] * d), (903, [float("inf")] + [0.0] * (d - 1)), (904, [None] * d), (905, [1.0] * (d + 1)), (906, [1e30] * d)]
    repeated = rows + [rows[4], (None, rows[5][1])]
    x, mean, values, vectors = brute(repeated)
    got = whitening.whiten(table(spark, repeated + odd)).toPandas()
    assert len(got) == len(repeated) * components and set(got["n"]) == {len(repeated)} and got["identity_error"].nunique() == 1
    assert got["identity_error"].iloc[0] < 1e-9
    exact = {(k, sum((len(x) * int(c) - int(s)) ** 2 for c, s in zip(row, x.sum(axis=0), strict=True))) for (k, _), row in zip(repeated, x, strict=True) if k is not None}
    assert {(int(k), int(v)) for k, v in got.dropna(subset=["vec_id"])[["vec_id", "deviation"]].drop_duplicates().to_numpy()} == exact
    for component in (1, 2, components):
        own = got[got["component"] == component]
        assert np.allclose(own["explained"], values[component - 1] / values.sum(), rtol=1e-9)
        wanted = dict(zip([k for k, _ in repeated], (x - mean) @ vectors[:, component - 1] / np.sqrt(values[component - 1]), strict=True))
        held = own.dropna(subset=["vec_id"]).drop_duplicates("vec_id").set_index("vec_id")["whitened"]
        signs = {round(held[k] / wanted[k], 6) for k in held.index if abs(wanted[k]) > 1e-3}
        assert signs in ({1.0}, {-1.0})


def test_flat_dimensions_and_single_rows_have_no_component(spark):
    flat = [(k, [float(k % 3), 5.0, 2.0 * (k % 3)]) for k in range(30)]
    got = whitening.whiten(table(spark, flat)).toPandas()
    assert set(got["component"]) == {1} and got["identity_error"].iloc[0] < 1e-9 and np.allclose(got["explained"], 1.0)
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [3.0]), (2, [3.0])]):
        out = whitening.whiten(table(spark, rows))
        assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviations_beyond_a_long_are_null():
    x = np.array([[1 << 20], [0]])
    assert whitening.deviations(x, 1 << 13, np.array([0])) == [None, 0]
    assert whitening.deviations(x, 4, np.array([1])) == [((1 << 22) - 1) ** 2, 1]


def test_clashing_columns(spark):
    rows = [(k, [float(k), float(k * k % 7)]) for k in range(20)]
    wide = table(spark, rows).selectExpr("*", "1 as v", "2 as component", "3 as n", "4 as i", "5 as d", "6 as label")
    key = lambda df: sorted(map(tuple, df.select("vec_id", "component", "deviation").collect()))
    assert key(whitening.whiten(wide)) == key(whitening.whiten(table(spark, rows)))
