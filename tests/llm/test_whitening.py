import math
import random
from fractions import Fraction

import numpy as np
import pytest

from fraudlane.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<double>, label int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA)


def cloud(n, length, seed=1, spread=0.2):
    pick = random.Random(seed)
    return [[pick.gauss(0, spread * (1 + j % 7)) for j in range(length)] for _ in range(n)]


def whole(vectors):
    return np.array([[math.floor(1024 * c) + 100_000 for c in v] for v in vectors], dtype=np.int64)


def test_gram_is_exact_for_any_size():
    pick = random.Random(2)
    for reach in (1, 1 << 17, 1 << 40, 1 << 62):
        rows = np.array([[pick.randint(-reach, reach) for _ in range(3)] for _ in range(50)], dtype=np.int64)
        want = [[sum(int(r[i]) * int(r[j]) for r in rows) for j in range(3)] for i in range(3)]
        assert wh.gram(rows).tolist() == want


def charpoly(matrix):
    """Faddeev and LeVerrier's recurrence in fractions."""
    d = len(matrix)
    m = [[Fraction(0)] * d for _ in range(d)]
    coefficients = [Fraction(0)] * d + [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(Fraction(matrix[i][x]) * m[x][j] for x in range(d)) + (coefficients[d - k + 1] if i == j else 0) for j in range(d)] for i in range(d)]
        product = [sum(Fraction(matrix[i][x]) * m[x][i] for x in range(d)) for i in range(d)]
        coefficients[d - k] = -sum(product) / k
    return [int(c) for c in coefficients]


def test_polynomial_and_roots_are_exact(spark):
    rows = [[3, 1, 0, 0, 2], [1, 0, 0, 5, 1], [0, 0, 0, 0, 0], [7, 1, 2, 5, 1], [2, 2, 0, 1, 9], [4, 4, 0, 2, 18]]
    matrix = [[sum(r[i] * r[j] for r in rows) for j in range(5)] for i in range(5)]
    poly = wh.characteristic_polynomial(spark, matrix)
    assert poly == charpoly(matrix)
    rank = 5 - next(i for i, c in enumerate(poly) if c)
    want = sorted(np.linalg.eigvalsh(np.array(matrix, float)), reverse=True)
    assert rank == np.linalg.matrix_rank(np.array(matrix))
    got = wh.largest_roots(poly[5 - rank :], rank)
    assert np.allclose([float(r) for r in got], want[:rank], rtol=1e-9)


def test_large_matrix_and_multiple_roots(spark):
    big = 1 << 70
    matrix = [[2 * big, big, 0, 0], [big, 2 * big, 0, 0], [0, 0, 3 * big, 0], [0, 0, 0, 5]]
    poly = wh.characteristic_polynomial(spark, matrix)
    assert poly == charpoly(matrix)
    roots = wh.largest_roots(poly, 4)
    assert [float(r) for r in roots] == pytest.approx([3.0 * big, 3.0 * big, float(big), 5.0])
    axes = np.array(wh.null_vectors(matrix, roots))
    assert np.allclose(axes @ axes.T, np.eye(4), atol=1e-14)
    assert np.allclose(np.array(matrix, float) @ axes.T / big, axes.T * [3, 3, 1, 0], atol=1e-12)


@pytest.mark.parametrize("length,n", [(12, 150), (3, 40), (64, 90)])
def test_equals_a_direct_decomposition(spark, length, n):
    vectors = cloud(n, length, seed=length)
    x = whole(vectors)
    got = wh.whiten(frame(spark, vectors).repartition(5)).collect()
    k = min(8, length)
    assert len(got) == n * k
    centred = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    sums = x.sum(axis=0)
    for r in got:
        assert r.n == n and r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[r.vec_id], sums))
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        want = centred[r.vec_id] @ axes[:, r.component - 1] / math.sqrt(values[r.component - 1])
        assert abs(r.whitened) == pytest.approx(abs(want), abs=1e-8)
        assert r.identity_error < 1e-9
    assert len({r.identity_error for r in got}) == 1
    # Whitened rows keep the signs of one axis for all rows.
    table = np.zeros((n, k))
    for r in got:
        table[r.vec_id, r.component - 1] = r.whitened
    assert np.allclose(table.T @ table / n, np.eye(k), atol=1e-9)


def test_odd_vectors(spark, rows_of):
    good = cloud(20, 4)
    rows = [(i, v, "x") for i, v in enumerate(good)]
    rows += [(100, None, "x"), (101, [], "x"), (102, [1.0, None, 1.0, 1.0], "x"), (103, [1.0, float("nan"), 0.0, 0.0], "x")]
    rows += [(104, [float("inf"), 0.0, 0.0, 0.0], "x"), (105, [1.0, 2.0], "x"), (106, [1e300, 0.0, 0.0, 0.0], "x"), (None, good[0], "x"), (3, good[3], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n string")
    got = wh.whiten(df).collect()
    assert sorted({-1 if r.vec_id is None else r.vec_id for r in got}) == [-1, *range(20)]
    assert len(got) == 22 * 4 and {r.n for r in got} == {22}
    clashing = df.selectExpr("*", *(f"'x' AS `{c}`" for c in ("x", "component", "deviation", "whitened", "explained", "at")))
    assert rows_of(wh.whiten(clashing)) == rows_of(wh.whiten(df))


def test_without_spread_there_are_no_components(spark):
    assert wh.whiten(frame(spark, [])).count() == 0
    assert wh.whiten(frame(spark, [[0.5, 0.25]] * 7)).count() == 0
    line = wh.whiten(frame(spark, [[0.1 * i, 0.2 * i, 1.0] for i in range(2)])).collect()
    assert {r.component for r in line} == {1} and len(line) == 2


def test_deviation_beyond_a_long_is_null(spark):
    got = wh.whiten(frame(spark, [[1e12, 0.0], [-1e12, 1.0], [3.0, 4.0]])).collect()
    assert len(got) == 6 and all(r.deviation is None for r in got if r.vec_id < 2)
    assert all(math.isfinite(r.whitened) for r in got)
