"""Exact scatter, polynomial, roots and components against numpy and exact integers."""

import math
from fractions import Fraction

import numpy as np
import pytest

from pagetrail.llm import whitening


def brute(rows):
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in rows]
    n, d = len(x), len(x[0])
    s = [sum(v[j] for v in x) for j in range(d)]
    deviation = [sum((n * v[j] - s[j]) ** 2 for j in range(d)) for v in x]
    centred = np.array([[float(Fraction(n * v[j] - s[j], n)) for j in range(d)] for v in x])
    return n, deviation, centred


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in enumerate(rows)], "vec_id bigint, embedding array<float>, v string, component int")


def test_whitened_rows_match_numpy(spark):
    rng = np.random.default_rng(3)
    rows = (rng.normal(size=(150, 10)) @ np.diag(np.linspace(0.2, 2, 10))).astype(np.float32).tolist()
    rows[7] = rows[8]
    odd = [None, [None] * 10, [float("nan")] * 10, [float("inf")] + [0.0] * 9, [], [1.0, 2.0]]
    got = whitening.whiten(table(spark, rows + odd), 4).collect()
    n, deviation, centred = brute(rows)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    assert len(got) == 4 * n and {r.vec_id for r in got} == set(range(n))
    for r in got:
        k = 10 - r.component
        lead = np.argmax(np.abs(vectors[:, k]))
        own = vectors[:, k] * np.sign(vectors[lead, k])
        assert (r.n, r.deviation) == (n, deviation[r.vec_id])
        assert r.whitened == pytest.approx(centred[r.vec_id] @ own / math.sqrt(values[k]), abs=1e-9)
        assert r.explained == pytest.approx(values[k] / values.sum(), rel=1e-9)
        assert 0 <= r.identity_error < 1e-9
    assert len({r.identity_error for r in got}) == 1


def test_large_entries_stay_exact(spark):
    kind = "vec_id bigint, embedding array<double>"
    rows = [[2.0**34 + i, -(2.0**20) * i, 0.0] for i in range(5)]
    got = whitening.whiten(spark.createDataFrame(list(enumerate(rows)), kind), 32).collect()
    assert {r.vec_id: r.deviation for r in got} == dict(enumerate(brute(rows)[1]))
    assert {r.component for r in got} == {1}  # the second dimension is a multiple of the first, the third constant
    with pytest.raises(Exception, match="does not fit in 64 bits"):
        whitening.whiten(spark.createDataFrame([(1, [2.0**40]), (2, [0.0])], kind)).collect()


@pytest.mark.parametrize("rows", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 3])
def test_nothing_to_whiten(spark, rows):
    got = whitening.whiten(table(spark, rows))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and got.count() == 0


def test_repeated_eigenvalues_get_an_orthonormal_basis(spark):
    signs = [[s * (a == b) for b in range(4)] for a in range(4) for s in (-1.0, 1.0)]  # the same variance in every dimension
    got = whitening.whiten(table(spark, signs)).collect()
    assert len(got) == 8 * 4 and all(r.explained == pytest.approx(0.25) and r.identity_error < 1e-9 for r in got)


def test_polynomial_and_roots_are_exact(spark):
    rng = np.random.default_rng(5)
    a = rng.integers(-50, 50, (6, 9)).astype(object)
    m = a.T.dot(a)  # of rank 6: three roots are 0
    poly = whitening.characteristic_polynomial(spark, m)
    power, k, want = np.eye(9, dtype=int).astype(object), 9, [0] * 9 + [1]
    for step in range(1, 10):  # Faddeev-LeVerrier
        product = m.dot(power)
        c = -Fraction(int(np.trace(product)), step)
        want[9 - step] = int(c)
        power = product + int(c) * np.eye(9, dtype=int).astype(object)
    assert poly == want and poly[:3] == [0, 0, 0]
    roots = whitening.largest_roots(poly, 9)
    values = np.linalg.eigvalsh(m.astype(float))[::-1]
    assert [r.times for r in roots] == [1] * 6
    assert [float(r.decimal()) for r in roots] == pytest.approx(values[:6].tolist(), rel=1e-9)


def test_roots_close_together_are_told_apart():
    x = 10**12  # (x - 10**12)(x - 10**12 - 1)(x - 7)**2
    poly = [1]
    for root in (x, x + 1, 7, 7):
        poly = [(poly[k - 1] if k else 0) - root * (poly[k] if k < len(poly) else 0) for k in range(len(poly) + 1)]
    found = whitening.largest_roots(poly, 4)
    assert [(round(float(r.decimal())), r.times) for r in found] == [(x + 1, 1), (x, 1), (7, 2)]
