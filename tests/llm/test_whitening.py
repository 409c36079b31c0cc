import math
import random

import numpy as np
import pytest

from framelake.llm import entries, whitening
from tests.helpers import SMALL


@pytest.mark.parametrize("v", [
    *(np.cov(np.random.default_rng(d).standard_normal((300, d)).T).reshape(d, d) for d in (1, 2, 5, 40)), np.eye(6) * 3, np.diag([5.0, 5, 5, 1, 1, 0]), np.diag([5, 5 * (1 - 1e-15), 3, 1, 1e-8, 0]),
    np.outer([1.0, 2, 3], [1.0, 2, 3]), 1e12 * np.diag(np.logspace(0, -12, 20)), 1e-12 * np.diag(np.logspace(0, -12, 20)), np.diag([7, 6.9999999, 6.9999998, 1, 0.5]),
])
def test_leading_eigenvalues(v):
    values, vectors = whitening.leading(v)
    want = np.linalg.eigvalsh(v)[::-1][:4]
    want = want[want > 1e-14 * want[0]]
    assert len(values) == len(want) and np.allclose(values, want, rtol=1e-12, atol=1e-15 * want[0])
    assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-14)
    assert np.abs(v @ vectors.T - vectors.T * values).max() <= 1e-14 * np.abs(v).max() * len(v)


def test_no_variance():
    assert len(whitening.leading(np.zeros((5, 5)))[0]) == 0


def test_inertia_counts():
    rng = np.random.default_rng(3)
    for d in (1, 2, 3, 8, 30):
        for _ in range(20):
            v = rng.integers(-3, 4, (d, d)).astype(float)
            v += v.T
            e = np.linalg.eigvalsh(v)
            for s in (-2.5, 0.5, 1.37):
                if np.abs(e - s).min() > 1e-9:
                    assert whitening.inertia(v, s) == ((e > s).sum(), 0, (e < s).sum())
    assert whitening.inertia(np.diag([1.0, 0, 0, -2]), 0.0) == (1, 2, 1)


def test_products_are_exact():
    rng = random.Random(4)
    for top in (300, (1 << 20) - 1, (1 << 39)):
        y = [[rng.randrange(-top, top + 1) for _ in range(3)] for _ in range(50)]
        want = [[sum(r[i] * r[j] for r in y) for j in range(3)] for i in range(3)]
        assert whitening.exact_products(np.array(y)) == want


def plain(rows):
    """{id: (deviation, whole vector)}, and the fit, by numpy."""
    kept = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v and len(v) == 6 and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), float)
    n, s = len(fit), [sum(int(c) for c in col) for col in fit.T]
    d = fit - fit.mean(axis=0)
    v = d.T @ d / n
    return kept, n, s, v


def check(out, rows, dims=6):
    kept, n, s, v = plain(rows)
    e, z = np.linalg.eigh(v)
    e, z = e[::-1], z[:, ::-1]
    got = sorted((tuple(r) for r in out.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error").collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[3], r[1]))
    assert len(got) == 4 * len(kept)
    assert sorted((i is not None, i or 0, sum((n * c - t) ** 2 for c, t in zip(x, s, strict=True))) for i, x in kept for _ in range(4)) == [(r[0] is not None, r[0] or 0, r[3]) for r in got]
    assert {r[2] for r in got} == {n} and len({r[6] for r in got}) == 1 and got[0][6] < 1e-8
    for k in range(4):
        assert {r[5] for r in got if r[1] == k + 1} == {got[k][5]} and math.isclose(got[k][5], e[k] / v.trace(), rel_tol=1e-10)
        want = sorted(abs(float((np.array(x) - np.array(s) / n) @ z[:, k])) / e[k] ** 0.5 for _, x in kept)
        assert np.allclose(sorted(abs(r[4]) for r in got if r[1] == k + 1), want, rtol=1e-7, atol=1e-9)


@pytest.mark.parametrize("exact", [1 << 40, 1])
def test_odd_rows(spark, monkeypatch, exact):
    monkeypatch.setattr(whitening, "EXACT", exact)
    rng = random.Random(2)
    rows = [(i, [rng.gauss(5, 1 + k) for k in range(6)]) for i in range(60)]
    rows += [(None, rows[0][1]), (3, rows[0][1]), (3, rows[1][1]), (70, None), (71, []), (72, [1.0] * 5), (73, [None] + [1.0] * 5), (74, [math.nan] * 6), (75, [math.inf] + [0.0] * 5), (76, [-0.0] * 6)] + [(80, rows[5][1])] * 40
    table = spark.createDataFrame([(*r, "own", 7) for r in rows], "vec_id long, embedding array<double>, x string, n int")
    check(whitening.whiten(table), rows)
    assert whitening.whiten(table.limit(0)).count() == 0
    assert whitening.whiten(table.where("vec_id >= 70 and vec_id < 72")).count() == 0
    assert whitening.whiten(table.where("vec_id = 80")).count() == 0  # a single vector has no variance
    large = spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 1.0])], "vec_id long, embedding array<double>")
    assert {r.deviation for r in whitening.whiten(large).collect()} == {None}


def test_query_equals_numpy(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    kept = [(i, np.floor(256 * np.array(v))) for i, v in rows]
    x = np.unique(np.array([v for _, v in kept]), axis=0)
    d = x - x.mean(axis=0)
    v = d.T @ d / len(x)
    e, z = np.linalg.eigh(v)
    out = entries.op12_whitening(spark, SMALL).collect()
    assert len(out) == 4 * len(rows)
    want = {i: np.abs((w - x.mean(axis=0)) @ z[:, ::-1][:, :4] / np.sqrt(e[::-1][:4])) for i, w in kept}
    assert all(abs(abs(r.whitened) - want[r.vec_id][r.component - 1]) < 1e-8 for r in out)
    assert out[0].identity_error < 1e-9
