import math

import numpy as np
import pytest

from tallyloom.llm import whitening

KIND = "vec_id long, embedding array<float>, label int"


def covariances():
    rng = np.random.default_rng(0)
    for d in (1, 2, 3, 40):
        a = rng.normal(size=(200, d))
        yield a.T @ a / 200
    q = np.linalg.qr(rng.normal(size=(48, 48)))[0]
    yield q @ np.diag([9.0] * 10 + [1.0] * 34 + [1e-9] * 4) @ q.T  # equal eigenvalues
    yield np.eye(40) * 3
    yield np.diag(np.arange(1.0, 41.0))
    yield np.ones((30, 30))
    low = rng.normal(size=(32, 5))
    yield low @ low.T


@pytest.mark.parametrize("matrix", list(covariances()), ids=lambda m: f"{len(m)}")
def test_leading_components(matrix):
    values, vectors = whitening.leading(matrix, 32)
    exact = np.sort(np.linalg.eigvalsh(matrix))[::-1]
    wanted = exact[:32][exact[:32] > 1e-10 * exact.sum()]
    assert np.allclose(values[: len(wanted)], wanted, rtol=1e-12 * exact[0] / wanted[-1], atol=0)
    assert len(values) >= len(wanted)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-13 * exact[0]


def test_sturm_counts():
    rng = np.random.default_rng(4)
    diagonal, side = rng.normal(size=12), rng.normal(size=11)
    side[5] = 0
    exact = np.linalg.eigvalsh(np.diag(diagonal) + np.diag(side, 1) + np.diag(side, -1))
    at = (exact[1:] + exact[:-1]) / 2
    assert whitening.below(diagonal, side, at).tolist() == list(range(1, 12))


def test_reflections_keep_the_spectrum():
    a = np.random.default_rng(5).normal(size=(20, 20))
    a = a + a.T
    diagonal, side, _ = whitening.tridiagonal(a)
    t = np.diag(diagonal) + np.diag(side, 1) + np.diag(side, -1)
    assert np.allclose(np.linalg.eigvalsh(t), np.linalg.eigvalsh(a), atol=1e-12)


def made():
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=6).astype("f4").tolist(), 0) for i in range(300)]
    rows += [(None, rows[0][1], 1), (5, rows[0][1], 1)] + [(1000 + i, rows[3][1], 1) for i in range(150)]
    bad = [(900, None, 0), (901, [], 0), (902, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (903, [math.nan] + [0.0] * 5, 0), (904, [math.inf] + [0.0] * 5, 0), (905, [1.0], 0)]
    return rows, bad


def test_whitened_rows(spark):
    rows, bad = made()
    out = whitening.whitened(spark.createDataFrame(rows + bad, KIND).repartition(5), 4).toPandas()
    x = np.floor(64 * np.array([r[1] for r in rows], "f4").astype(float)).astype(int) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    assert len(out) == 4 * n and set(out["n"]) == {n} and set(out["component"]) == {1, 2, 3, 4}
    deviation = {}
    for (i, _, _), v in zip(rows, x):
        deviation.setdefault(i, set()).add(int(((n * v - s) ** 2).sum()))
    assert {-1 if i != i else int(i): set(g) for i, g in out.fillna({"vec_id": -1}).groupby("vec_id")["deviation"]} == {-1 if i is None else i: d for i, d in deviation.items()}
    centred = x - s / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1][:4]
    wanted = centred @ vectors[:, order] / np.sqrt(values[order])
    got = out[out["vec_id"] == 17].sort_values("component")["whitened"].to_numpy()
    assert np.allclose(np.abs(got), np.abs(wanted[17]), atol=1e-9)
    whole = np.stack([g.sort_values(["vec_id", "deviation"])["whitened"].to_numpy() for _, g in out.groupby("component")])
    assert np.abs(np.cov(whole, bias=True) - np.eye(4)).max() < 1e-9 and out["identity_error"].max() < 1e-9
    assert np.allclose(out.groupby("component")["explained"].first(), values[order] / values.sum(), rtol=1e-9)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0)] * 3, [(1, None, 0)]])
def test_without_variance_there_are_no_components(spark, rows):
    out = whitening.whitened(spark.createDataFrame(rows, KIND))
    assert out.count() == 0 and out.columns[:4] == ["vec_id", "component", "n", "deviation"]


def test_huge_entries_have_no_exact_deviation(spark):
    rows = [(i, [float(i % 7), 3e38 if i % 2 else -3e38], 0) for i in range(20)]
    out = whitening.whitened(spark.createDataFrame(rows, KIND)).toPandas()
    assert len(out) == 20 and out["deviation"].isna().all() and out["identity_error"].max() < 1e-4
