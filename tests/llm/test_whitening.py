import numpy as np
import pytest

from tillroll.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, x string, dim string, n string, component string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "z", "z", "z", "z") for i, v in rows], SCHEMA).repartition(3)


def brute(vectors):
    """n, deviations, eigenvalues and components by the covariance in long double."""
    x = np.floor(64 * np.asarray(vectors, np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    deviation = [sum(int(v) ** 2 for v in n * row - sums) for row in x]
    a = ((n * fit - sums).astype(np.longdouble) / n).astype(np.float64)
    values, components = np.linalg.eigh(a.T @ a / n)
    return x, n, sums, deviation, values[::-1], components[:, ::-1]


def by_row(rows):
    out = {}
    for r in sorted(rows, key=lambda r: r["component"]):
        out.setdefault(r["vec_id"], []).append(r)
    return out


def test_against_the_covariance(spark):
    rng = np.random.default_rng(5)
    scales = np.geomspace(30, 0.2, 24)
    vectors = (rng.normal(size=(900, 24)) * scales) @ np.linalg.qr(rng.normal(size=(24, 24)))[0]
    vectors[600:] = vectors[3]  # a third of the rows are copies
    got = by_row(whitening.whiten(table(spark, list(enumerate(vectors.tolist())))).collect())
    x, n, sums, deviation, values, components = brute(vectors)
    assert len(got) == 900 and all(len(v) == 16 for v in got.values())
    want = (x - sums / n) @ components[:, :16] / np.sqrt(values[:16])
    signs = np.sign([r["whitened"] for r in got[0]]) * np.sign(want[0])
    for i, rows in got.items():
        assert [r["component"] for r in rows] == list(range(1, 17))
        assert {(r["n"], r["deviation"]) for r in rows} == {(n, deviation[i])}
        assert np.allclose([r["whitened"] for r in rows], want[i] * signs, atol=1e-9)
        assert np.allclose([r["explained"] for r in rows], values[:16] / values.sum(), rtol=1e-10)
    assert {r["identity_error"] for rows in got.values() for r in rows}.pop() < 1e-10


@pytest.mark.parametrize("condition", [1e3, 1e7])
def test_ill_conditioned_rows(spark, condition):
    """Components of little variance beside very great ones are resolved."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(4000, 6)) * np.geomspace(condition, 1, 6)
    x = np.round(base).astype(np.int64)
    x[:, 5] += x[:, 0]  # the small direction is hidden in a difference of two large columns
    fit = np.unique(x, axis=0)
    frame = spark.createDataFrame([(6, row.tolist()) for row in fit], "dim long, x array<long>").repartition(3)
    model = whitening.fit_whitening(frame)[6]
    a = model.centred(fit)
    _, values, vectors = np.linalg.svd(a, full_matrices=False)
    assert np.allclose(model.eigenvalues, values**2 / len(fit), rtol=1e-6)
    assert np.allclose(np.abs((model.components * vectors.T).sum(axis=0)), 1, atol=1e-9)
    assert model.identity_error < 1e-4 and 3 <= len(model.factors) <= whitening.MAX_PASSES


def test_triangular_solve_and_factor():
    rng = np.random.default_rng(7)
    rows = rng.normal(size=(50, 8))
    factor = whitening.shifted_factor(rows.T @ rows, 50)
    assert np.allclose(np.tril(factor, -1), 0)
    q = whitening.solved(rows, factor)
    assert np.allclose(q @ factor, rows) and np.allclose(q.T @ q, np.eye(8), atol=1e-8)


def test_no_variance_in_some_directions(spark):
    rng = np.random.default_rng(8)
    a = rng.integers(-50, 50, size=(200, 3)) / 64
    vectors = np.column_stack((a, a[:, 0], np.full(200, 3.5), a.sum(axis=1)))
    got = by_row(whitening.whiten(table(spark, list(enumerate(vectors.tolist())))).collect())
    assert all(len(v) == 3 for v in got.values()) and len(got) == 200
    assert abs(sum(r["explained"] for r in got[0]) - 1) < 1e-9
    assert got[0][0]["identity_error"] < 1e-9


def test_great_deviations_stay_exact():
    model = whitening.Whitening(10**7, np.array([10**15, -(10**15)]))
    x = np.array([[10**12, 5], [100, -100]])
    want = [sum((10**7 * int(v) - s) ** 2 for v, s in zip(row, (10**15, -(10**15)))) for row in x]
    assert whitening._squares(model.deviations(x)).to_pylist() == [v if v < 1 << 63 else None for v in want]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.5]), (2, None), (3, []), (4, [nan, 1.0]), (5, [inf, 1.0]),
        (6, [0.0, 0.0]), (7, [1.0, None]), (None, [3.0, -2.0]), (8, [3.0, 4.0, 5.0]), (9, [3.0, 4.0, 6.0]), (10, [1.0]),
    ]
    got = by_row_ids(whitening.whiten(table(spark, rows)).collect())
    assert got == {0: (4, 4), 1: (2, 4), 6: (2, 4), None: (2, 4), 8: (1, 2), 9: (1, 2)}


def by_row_ids(rows):
    out = {}
    for r in rows:
        count, _ = out.get(r["vec_id"], (0, 0))
        out[r["vec_id"]] = count + 1, r["n"]
    return out


def test_without_vectors_or_variance(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(i, [1.0, 2.0]) for i in range(5)])).count() == 0
