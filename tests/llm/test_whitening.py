import math
from fractions import Fraction

import numpy as np
import pytest

from palimpsest.llm import queries, whitening

SHAPE = "vec_id long, embedding array<float>, component string, x string, n int"


def run(spark, rows, shape=SHAPE):
    return whitening.whiten(spark.createDataFrame([(i, v, "a", "b", 1) for i, v in rows], shape)).collect()


def check(rows, found):
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in kept], object)
    n, d = x.shape
    sums = x.sum(axis=0)
    deviation = {(i, int(((n * r - sums) ** 2).sum())) for (i, _), r in zip(kept, x, strict=True)}
    k = min(8, d)
    assert len(found) == n * k and {(r.vec_id, r.deviation) for r in found} == deviation and {r.n for r in found} == {n}
    a = np.array([[float(Fraction(int(n * v - s), n)) for v, s in zip(r, sums, strict=True)] for r in x])
    _, s, vt = np.linalg.svd(a, full_matrices=False)
    e = s**2 / n
    for c in range(k):
        mine = [r for r in found if r.component == c + 1]
        assert {r.identity_error < 1e-9 for r in mine} == {True}
        if c < len(e) and e[c] > 1e-18 * e[0] and e[0] > 0:
            assert all(abs(r.explained - e[c] / e.sum()) <= 1e-9 * e[c] / e.sum() for r in mine)
            want = dict(zip([i for i, _ in kept], a @ vt[c] / math.sqrt(e[c]), strict=True))
            sign = np.sign(sum(want[r.vec_id] * r.whitened for r in mine))
            assert max(abs(sign * want[r.vec_id] - r.whitened) for r in mine) < 1e-6
        else:
            assert {r.whitened for r in mine} == {None}


def test_awkward_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.normal(size=11) * 2.0 ** -np.arange(11)]) for i in range(300)]
    rows += [(400, None), (401, [None] + [1.0] * 10), (402, [math.nan] * 11), (403, [math.inf] * 11), (404, rows[0][1])]
    check(rows, run(spark, rows))
    odd = [(500, [1.0, 2.0]), (501, []), (502, [3e38] * 11)]
    again = run(spark, rows + odd)
    assert {r.vec_id for r in again} == {i for i, _ in rows} - {400, 401, 402, 403}


def test_hot_vector_and_large_offset(spark):
    rng = np.random.default_rng(2)
    hot = [float(v) for v in rng.normal(size=9)]
    rows = [(i, hot) for i in range(400)] + [(400 + i, [float(v) for v in rng.normal(size=9) + 30]) for i in range(200)]
    check(rows, run(spark, rows))


def test_without_variance(spark):
    check([(1, [0.5, 0.25, 1.0])] * 1, run(spark, [(1, [0.5, 0.25, 1.0])]))
    rows = [(i, [float(i), 2.0 * i, 1.0]) for i in range(20)]
    check(rows, run(spark, rows))
    assert run(spark, []) == [] and run(spark, [(1, None)]) == []


def test_ids_stay(spark):
    found = run(spark, [(None, [1.0, 0.0]), (7, [0.0, 1.0]), (7, [0.0, 3.0])])
    assert sorted((r.vec_id or 0, r.component) for r in found) == [(0, 1), (0, 2), (7, 1), (7, 1), (7, 2), (7, 2)]


def test_ill_conditioned(spark):
    """Spread over nine decades: one Gram matrix's eigenvalues would have lost the small ones."""
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(8, 8)))
    rows = [(i, [float(v) for v in (rng.normal(size=8) * 10.0 ** np.linspace(6, -1, 8)) @ q]) for i in range(500)]
    x = np.array([[math.floor(1024 * v) + 100_000 for v in r] for _, r in rows], float)
    e = np.linalg.svd(x - x.mean(axis=0), compute_uv=False) ** 2 / len(x)
    found = run(spark, rows, SHAPE.replace("float", "double"))
    got = {r.component: r.explained for r in found}
    assert all(abs(got[k + 1] * e.sum() / e[k] - 1) < 1e-4 for k in range(8)) and found[0].identity_error < 1e-4


def test_query(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(rows, queries.QUERIES["op13_whitening"](spark, sf).collect())


@pytest.mark.parametrize("first", [True, False])
def test_factor(first):
    a = np.ones((5, 3))
    r = whitening._factor(a.T @ a, 5, first)
    assert np.allclose(r.T @ r, a.T @ a, atol=1e-6)
