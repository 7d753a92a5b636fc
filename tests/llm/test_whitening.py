from fractions import Fraction

import numpy as np
import pytest

from tallybrook.llm import whitening


def brute(rows, k=4):
    """vec_id, deviation and whitened values (sign apart) of each row, and what all rows share, by the whole covariance."""
    kept = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(c) - Fraction(s, n)) for c, s in zip(x, sums)] for x in fit])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    out = {}
    for i, x in kept:
        w = np.array([c - s / n for c, s in zip(x, sums)]) @ u[:, :k] / np.sqrt(np.maximum(e[:k], 1e-300))
        out.setdefault(i, []).append((sum((n * c - s) ** 2 for c, s in zip(x, sums)), w))
    return n, out, e[:k] / e.sum() if e.sum() else 0 * e[:k]


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, x int, component string").repartition(3)


def check(spark, rows, k=4, **options):
    n, want, explained = brute(rows, k)
    found = whitening.whiten(table(spark, rows), k, **options).collect()
    assert len(found) == k * sum(map(len, want.values()))
    values = {}
    for r in found:
        assert r["n"] == n and r["identity_error"] <= 1e-9 and abs(r["explained"] - explained[r["component"] - 1]) <= 1e-9 * explained[0]
        values.setdefault((r["vec_id"], int(r["deviation"])), {})[r["component"]] = r["whitened"]
    pairs = [(values[i, d], w) for i, of in want.items() for d, w in of]
    for c in range(k):
        got, expected = np.array([p[0][c + 1] for p in pairs]), np.array([p[1][c] for p in pairs])
        assert np.abs(got - np.sign(got @ expected) * expected).max() <= 1e-7


def test_matches_the_whole_covariance(spark):
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(0, 0.3, (200, 12)) * np.linspace(1, 3, 12))]
    rows += [(i, rows[0][1]) for i in range(300, 400)] + [(7, rows[9][1]), (None, rows[8][1])]  # a hot vector, a repeated and a null id
    rows += [(900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [float("-inf")] * 12), (904, [])]
    check(spark, rows)
    check(spark, rows, block=2, basis=8)  # many passes and restarts
    check(spark, rows, k=12)


@pytest.mark.parametrize("flat", [True, False])
def test_restarts_find_the_leading_pairs_of_a_large_matrix(flat):
    rng = np.random.default_rng(4)
    e = np.linspace(1, 2, 300) if flat else 0.9 ** np.arange(300)
    u = np.linalg.qr(rng.standard_normal((300, 300)))[0]
    v = u @ np.diag(e) @ u.T
    found, vectors, passes = whitening.leading_pairs(lambda q: v @ q, 300, 4, 8, 48, 1e-13)
    assert np.allclose(found, np.sort(e)[::-1][:4], rtol=1e-12) and passes > 6
    assert np.abs(v @ vectors - vectors * found).max() < 1e-12


def test_equal_and_missing_variances():
    v = np.diag([3.0, 3.0, 1.0, 0.0, 0.0, 0.0])
    found, vectors, _ = whitening.leading_pairs(lambda q: v @ q, 6, 4, 2, 4, 1e-13)
    assert np.allclose(found, [3, 3, 1, 0]) and np.allclose(vectors.T @ vectors, np.eye(4))
    assert np.allclose(whitening.leading_pairs(lambda q: 0 * q, 5, 2, 2, 4, 1e-13)[0], 0)


def test_components_without_variance(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.5, 2.0]), (3, [0.5, 2.0])]
    found = whitening.whiten(table(spark, rows)).collect()
    assert sorted((r["vec_id"], r["component"]) for r in found) == [(i, c) for i in (1, 2, 3) for c in (1, 2)]
    assert all((r["whitened"] is None) == (r["component"] == 2) and r["identity_error"] < 1e-9 for r in found)
    assert {round(r["explained"], 12) for r in found if r["component"] == 1} == {1.0}
    alone = whitening.whiten(table(spark, rows[:1])).collect()
    assert [(r["whitened"], r["explained"], int(r["deviation"]), r["n"]) for r in alone] == [(None, 0.0, 0, 1)] * 2


def test_lengths_are_whitened_apart_and_nothing_gives_nothing(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.5, 2.5]), (3, [0.5, 2.0]), (4, [1.0]), (5, [2.0])]
    found = whitening.whiten(table(spark, rows)).collect()
    assert {(r["vec_id"], r["n"]) for r in found} == {(1, 3), (2, 3), (3, 3), (4, 2), (5, 2)}
    assert whitening.whiten(table(spark, [])).collect() == whitening.whiten(table(spark, [(1, None), (2, [])])).collect() == []


@pytest.mark.parametrize("top", [3, 1 << 20, 1 << 40, 1 << 60])
def test_square_sums_are_exact(top):
    rng = np.random.default_rng(1)
    y = rng.integers(-top, top, (20, 64))
    want = [sum(int(v) ** 2 for v in row) for row in y.tolist()]
    assert whitening.square_sums(y) == want == whitening.square_sums(y.astype(object))


def test_moments_and_deviations_beyond_64_bits(spark):
    rows = [(k, [float((-1) ** k * (1 << 44) / 256 * (k + 1)), float(k)]) for k in range(5)]
    n, want, _ = brute(rows, 2)
    assert {(r["vec_id"], int(r["deviation"])) for r in whitening.whiten(table(spark, rows), 2).collect()} == {(i, d) for i, of in want.items() for d, _ in of}
