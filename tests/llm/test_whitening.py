import math
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import whitening


def brute(vectors):
    """Covariance of the distinct grid vectors in fractions, then numpy's eigenvectors."""
    grid = [tuple(math.floor(256 * float(c)) for c in v) for v in vectors]
    fit = sorted(set(grid))
    n, d = len(fit), len(fit[0])
    sums = [sum(v[i] for v in fit) for i in range(d)]
    cov = [[sum(Fraction(n * v[i] - sums[i], n) * Fraction(n * v[j] - sums[j], n) for v in fit) / n for j in range(d)] for i in range(d)]
    return grid, fit, sums, cov


def characteristic(matrix):
    """Faddeev-LeVerrier in fractions, lowest power first."""
    d = len(matrix)
    a = np.array([[Fraction(v) for v in row] for row in matrix], object)
    m, c, one = np.zeros((d, d), object), [Fraction(1)], np.array([[Fraction(i == j) for j in range(d)] for i in range(d)], object)
    for k in range(1, d + 1):
        m = a @ m + c[-1] * one
        c.append(-(a @ m).trace() / k)
    return [int(x) for x in reversed(c)]


def random_scatter(rng, d, rank, n=30):
    x = rng.integers(-40, 40, (n, rank)) @ rng.integers(-3, 4, (rank, d))
    x = x - 0
    return [[int(v) for v in row] for row in n * (x.T @ x) - np.outer(x.sum(0), x.sum(0))]


@pytest.mark.parametrize("d, rank", [(1, 1), (2, 2), (6, 6), (9, 4), (12, 12)])
def test_polynomial_is_exact(spark, d, rank):
    scatter = random_scatter(np.random.default_rng(d), d, rank)
    assert whitening.characteristic_polynomial(spark, scatter) == characteristic(scatter)


def test_sparse_matrices_have_pivots_elsewhere(spark):
    block = [[0] * 6 for _ in range(6)]
    for i, v in enumerate([5, 5, 3, 0, 7, 2]):
        block[i][i] = v
    block[0][5] = block[5][0] = 2
    block[2][4] = block[4][2] = 1
    assert whitening.characteristic_polynomial(spark, block) == characteristic(block)


def test_roots_with_multiplicity():
    def product(*roots):
        p = [1]
        for r in roots:
            p = [(p[k - 1] if k else 0) - r * (p[k] if k < len(p) else 0) for k in range(len(p) + 1)]
        return p

    found = whitening.largest_roots(product(9, 9, 4, 1, 0, 0), 4)
    assert [(round(r), m) for r, m in found] == [(9, 2), (4, 1), (1, 1)]
    assert all(abs(r - round(r)) < Fraction(1, 2**200) for r, _ in found)
    assert whitening.largest_roots(product(0, 0), 4) == []
    assert [(round(r), m) for r, m in whitening.largest_roots(product(7, 7, 7, 7, 7), 4)] == [(7, 5)]
    # t^2 - 4t + 2
    found = whitening.largest_roots([2, -4, 1], 4)
    assert [m for _, m in found] == [1, 1] and all(abs((r - 2) ** 2 - 2) < Fraction(1, 2**200) for r, _ in found)
    # two roots that differ by less than a double tells apart
    near = product(10**20 + 1, 10**20)
    assert [(round(r), m) for r, m in whitening.largest_roots(near, 4)] == [(10**20 + 1, 1), (10**20, 1)]
    assert whitening.roots_above(near, 10**20, 0) == 1


def test_close_eigenvalues_have_exact_components():
    a = 10**16
    matrix = [[a, 1, 0], [1, a, 0], [0, 0, 3]]
    for root, sign in ((a + 1, 1), (a - 1, -1)):
        [v] = whitening.null_space(matrix, Fraction(root), 1)
        assert np.allclose(abs(v), [math.sqrt(0.5), math.sqrt(0.5), 0], atol=1e-15) and np.sign(v[0] * v[1]) == sign


def check(rows, got, components=4):
    """rows: (key, vector); against numpy, components up to their sign."""
    usable = [(k, v) for k, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    grid, fit, sums, cov = brute([v for _, v in usable])
    values, vectors = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    number = int((values > 1e-9 * max(values.max(), 1e-300)).sum())
    assert len(got) == len(usable) * number
    n = len(fit)
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    trace = float(sum(cov[i][i] for i in range(len(cov))))
    for (key, _), x in zip(usable, grid, strict=True):
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        found = by[key, deviation]
        assert sorted(found) == list(range(1, number + 1))
        for c in range(number):
            r = found[c + 1][0]
            assert r.n == n and r.explained == pytest.approx(values[c] / trace, rel=1e-6) and r.identity_error < 1e-9
            want = sum((a - s / n) * b for a, s, b in zip(x, sums, vectors[:, c], strict=True)) / math.sqrt(values[c])
            assert abs(r.whitened) == pytest.approx(abs(want), rel=1e-5, abs=1e-6)


def test_report_is_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, [1, 0.5, 0.3, 0.2, 0.1, 0.05], (80, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(200, rows[3][1]), (3, rows[3][1]), (None, rows[5][1]), (201, None), (202, []), (203, [None] * 6), (204, [float("nan")] * 6)]
    rows += [(205, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (206, [0.0, -0.0, 1e-9, -1e-9, 1.0, -1.0])]
    vectors = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "vec_id long, embedding array<double>, key long, x string, n int")
    got = whitening.report(vectors.repartition(3)).collect()
    check([(k, v) for k, v in rows if v != [None] * 6], got)
    shorter = spark.createDataFrame([(900, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert len(whitening.report(vectors.select("vec_id", "embedding").union(shorter)).collect()) == len(got)


def test_few_dimensions_and_few_vectors(spark):
    def run(rows, kind="array<float>"):
        return whitening.report(spark.createDataFrame(rows, f"vec_id long, embedding {kind}")).collect()

    assert run([]) == run([(1, [1.0, 2.0])]) == run([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == run([(1, None)]) == []
    two = [(1, [1.0, 2.0, 0.0]), (2, [0.0, 1.0, 0.5]), (2, [0.0, 1.0, 0.5])]
    check(two, run(two))
    line = [(i, [float(i)]) for i in range(5)]
    check(line, run(line))


def test_equal_eigenvalues(spark):
    corners = [(i, [float(a), float(b), float(c)]) for i, (a, b, c) in enumerate(np.ndindex(2, 2, 2))]
    got = whitening.report(spark.createDataFrame(corners, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 24 and all(r.explained == pytest.approx(1 / 3) and r.identity_error < 1e-12 for r in got)
    points = {}
    for r in got:
        points.setdefault(r.vec_id, []).append(r.whitened)
    assert all(sum(w * w for w in p) == pytest.approx(3) for p in points.values())


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(v) * 2.0**28 for v in rng.integers(-50, 50, 3)]) for i in range(12)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    grid = whitening.on_grid(vectors, "vec_id", "embedding")
    sums, products = whitening.moments(whitening.fit_list(grid), 3)
    x = np.array(sorted({tuple(int(256 * c) for c in v) for _, v in rows}), object)
    assert sums == x.sum(axis=0).tolist() and products == (x.T @ x).tolist()
    got = whitening.report(vectors).collect()
    assert len(got) == 36 and all(r.deviation is None and r.identity_error < 1e-9 for r in got)
