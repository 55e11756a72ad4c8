"""Factors, covariance and sampled similarities of tall matrices against numpy."""

from __future__ import annotations

import numpy as np
import pytest

from kindred.operators import matrix
from kindred.session import materialise


def table(spark, rows, parts):
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "id long, v array<double>")
    return df.repartition(parts)


@pytest.fixture(scope="module")
def rows():
    return np.random.default_rng(3).normal(size=(500, 6)) * [1, 10, 0.1, 5, 2, 1000] + [0, 3, 0, 1e6, 0, 0]


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_factors(spark, rows, parts):
    df = materialise(table(spark, rows, parts)).repartition(parts)
    q_rows, r = matrix.tall_qr(df, "id", "v", 6)
    q = np.array([x["q"] for x in sorted(q_rows.collect(), key=lambda x: x["id"])])
    assert np.allclose(r, np.triu(r)) and (np.diag(r) > 0).all()
    assert np.allclose(r.T @ r, rows.T @ rows, rtol=1e-9) and np.allclose(q @ r, rows) and np.allclose(q.T @ q, np.eye(6), atol=1e-6)
    left, values, right = matrix.svd(df, "id", "v", 6, 3)
    u = np.array([x["u"] for x in sorted(left.collect(), key=lambda x: x["id"])])
    assert np.allclose(values, np.linalg.svd(rows, compute_uv=False)[:3])
    assert np.allclose(u.T @ u, np.eye(3), atol=1e-8) and np.allclose(right.T @ right, np.eye(3))
    whole, s, v = matrix.svd(df, "id", "v", 6, 6)
    back = np.array([x["u"] for x in sorted(whole.collect(), key=lambda x: x["id"])]) * s @ v.T
    assert np.allclose(back, rows)
    # the mean of a column is a million times its spread
    assert np.allclose(matrix.covariance(df, "v", 6), np.cov(rows.T), rtol=1e-9)


def test_few_or_dependent_rows(spark):
    short = table(spark, np.array([[1.0, 2.0, 3.0]]), 2)
    assert np.allclose(np.abs(matrix.r_factor(short, "v", 3))[0], [1, 2, 3])
    assert np.isnan(matrix.covariance(short, "v", 3)).all()
    with pytest.raises(ValueError, match="depend"):
        matrix.tall_qr(short, "id", "v", 3)
    left, values, _ = matrix.svd(short, "id", "v", 3, 3)
    assert np.allclose(values, [14**0.5]) and np.allclose(np.abs(left.first()["u"]), [1])
    assert not matrix.r_factor(short.where("false"), "v", 3).any()


def test_sampled_similarities(spark):
    draw = np.random.default_rng(1)
    x = draw.random((20_000, 4))
    x[:, 1] = 0.7 * x[:, 0] + 0.3 * x[:, 1]
    x[:, 3] = 0
    df = materialise(table(spark, x, 8))
    norm = np.linalg.norm(x, axis=0)
    exact = {(i, j): x[:, i] @ x[:, j] / norm[i] / norm[j] for i, j in ((0, 1), (0, 2), (1, 2))}
    errors, products = [], []
    for seed in range(3):
        got = {(r["i"], r["j"]): r for r in matrix.sampled_column_cosines(df, "id", "v", 4, 0.05, seed).collect()}
        assert got[0, 3]["cosine"] == 0
        errors += [got[k]["cosine"] - v for k, v in exact.items()]
        products += [got[k]["products"] for k in exact]
        again = {(r["i"], r["j"]): r["cosine"] for r in matrix.sampled_column_cosines(df.repartition(3), "id", "v", 4, 0.05, seed).collect()}
        assert again == pytest.approx({k: r["cosine"] for k, r in got.items()})
    assert max(products) < len(x) / 10 and np.abs(errors).mean() < 0.05 and abs(np.mean(errors)) < 0.05
    # a low threshold keeps everything and is exact
    got = {(r["i"], r["j"]): r["cosine"] for r in matrix.sampled_column_cosines(df, "id", "v", 4, 1e-6).collect() if r["j"] < 3}
    assert got == pytest.approx(exact)
