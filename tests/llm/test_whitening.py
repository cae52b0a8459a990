import math
import random
from fractions import Fraction

import numpy as np
import pytest

from homeshift.llm import whitening as wh


def vectors_of(spark, rows, parts=3):
    schema = "vec_id long, embedding array<float>, label int, id int, v string, w int, dim string, n int"
    return spark.createDataFrame([(i, v, 0, 1, "x", 2, "d", 3) for i, v in rows], schema).repartition(parts)


def cloud(n, d, seed=1):
    rng = np.random.default_rng(seed)
    x = (rng.normal(size=(n, d)) * np.linspace(1, 0.2, d) @ np.linalg.qr(rng.normal(size=(d, d)))[0]).astype(np.float32)
    return [(i, row.tolist()) for i, row in enumerate(x)]


def plain(rows, k):
    x = np.floor(1024 * np.array([np.array(v, dtype=np.float32).astype(float) for _, v in rows])) + 100000
    c = x - x.mean(0)
    e, u = np.linalg.eigh(c.T @ c / len(x))
    return x, e[::-1][:k], e.sum(), c @ u[:, ::-1][:, :k] / np.sqrt(e[::-1][:k])


def test_equals_a_plain_eigen_decomposition(spark):
    rows = cloud(300, 12)
    got = wh.whitened_components(vectors_of(spark, rows)).toPandas()
    x, e, total, white = plain(rows, 8)
    table = got.pivot(index="vec_id", columns="component", values="whitened").values
    white *= np.sign((table * white).sum(0))
    assert np.abs(table - white).max() < 1e-9
    first = got[got.vec_id == 0].sort_values("component")
    assert np.allclose(first.explained, e / total, rtol=1e-12) and (got.identity_error < 1e-9).all() and (got.n == 300).all()
    n, s = len(x), x.sum(0)
    assert got[got.component == 1].sort_values("vec_id").deviation.tolist() == [int(sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s))) for r in x]


def test_edge_vectors(spark):
    rows = cloud(40, 3) + [(100, None), (101, [1.0, None, 2.0]), (102, [float("nan")] * 3), (103, [float("inf"), 0.0, 0.0]), (104, []), (105, [0.0] * 3), (105, [0.0] * 3), (None, [0.1, 0.2, 0.3])]
    rows += [(200 + i, [i / 7, i / 9]) for i in range(5)]  # another length: rank one, or nearly
    got = wh.whitened_components(vectors_of(spark, rows)).collect()
    ids = {r["vec_id"] for r in got}
    assert not ids & {100, 101, 102, 103, 104} and {105, None} <= ids
    assert {r["n"] for r in got if r["vec_id"] in (0, 105, None)} == {43}
    assert sum(r["vec_id"] == 105 for r in got) == 6
    assert {r["n"] for r in got if r["vec_id"] and r["vec_id"] >= 200} == {5}


def test_low_rank_and_empty(spark):
    flat = [(i, [float(i), 2.0 * i, 0.5]) for i in range(20)]
    got = wh.whitened_components(vectors_of(spark, flat)).collect()
    assert {r["component"] for r in got} == {1} and abs(got[0]["explained"] - 1) < 1e-12 and got[0]["identity_error"] < 1e-9
    assert wh.whitened_components(vectors_of(spark, [(i, [1.0, 2.0]) for i in range(5)])).count() == 0
    assert wh.whitened_components(vectors_of(spark, flat).where("false")).count() == 0


def test_huge_entries_are_summed_exactly(spark):
    rows = [(i, [1e30 * (i - 2), 3e7 + i, float(i * i)]) for i in range(5)]
    n, s, g = wh.scatter(wh.usable(vectors_of(spark, rows), "vec_id", "embedding"))[3]
    y = [[math.floor(1024 * Fraction(float(np.float32(v)))) for v in r] for _, r in rows]
    assert n == 5 and s == [sum(r[j] for r in y) for j in range(3)]
    assert g == [[sum(r[i] * r[j] for r in y) for j in range(3)] for i in range(3)]


def test_repeated_roots(spark):
    """A cross: both directions have the same variance, so any orthonormal pair is right."""
    rows = [(0, [1.0, 0.0, 0.0]), (1, [-1.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.0]), (3, [0.0, -1.0, 0.0]), (4, [0.0, 0.0, 3.0]), (5, [0.0, 0.0, -3.0])]
    got = wh.whitened_components(vectors_of(spark, rows)).collect()
    assert {r["component"] for r in got} == {1, 2, 3} and got[0]["identity_error"] < 1e-9


def leibniz(m):
    """Characteristic polynomial by Faddeev-LeVerrier in fractions."""
    d = len(m)
    c, a = [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
    for k in range(1, d + 1):
        a = [[sum(m[i][t] * a[t][j] for t in range(d)) + (c[-1] if i == j else 0) * 1 for j in range(d)] for i in range(d)] if k > 1 else [[Fraction(int(i == j)) for j in range(d)] for i in range(d)]
        ma = [[sum(m[i][t] * a[t][j] for t in range(d)) for j in range(d)] for i in range(d)]
        c.append(-sum(ma[i][i] for i in range(d)) / k)
    return [int(v) for v in reversed(c)]


@pytest.mark.parametrize("d, zero", [(1, 0), (2, 0), (5, 2), (9, 0), (9, 4)])
def test_polynomial_roots_and_null_vectors(spark, d, zero):
    rng = random.Random(d)
    b = [[rng.randint(-10**6, 10**6) if i < d - zero else 0 for _ in range(d)] for i in range(d)]
    m = [[sum(b[k][i] * b[k][j] for k in range(d)) for j in range(d)] for i in range(d)]
    poly = wh.characteristic_polynomial(spark, m)
    assert poly == leibniz(m)
    roots = wh.largest_roots(poly, d)
    assert sum(t for _, t in roots) == d - zero
    want = sorted(np.linalg.eigvalsh(np.array(m, dtype=float)))[::-1][: d - zero]
    assert np.allclose([r / 2**wh.BITS for r, _ in roots], want, rtol=1e-6)


def test_root_counts_are_exact():
    c = [1]
    for r in (3, 3, 7, 0, 11, 20):  # (x - r)
        c = [(c[i - 1] if i else 0) - r * (c[i] if i < len(c) else 0) for i in range(len(c) + 1)]
    assert [wh.roots_above(c, t) for t in (-1, 0, 2, 3, 10, 11, 20)] == [6, 5, 5, 3, 2, 1, 0]
    assert [(r >> 4, m) for r, m in wh.largest_roots(c, 5, 4)] == [(20, 1), (11, 1), (7, 1), (3, 2)]


def test_primes():
    assert [n for n in range(2, 60) if n % 2 and wh.is_prime(n)] == [11, 13, 17, 19, 23, 29, 31, 37, 41, 43, 47, 53, 59]
    assert wh.primes_for(1)[0] == 2**31 - 1
