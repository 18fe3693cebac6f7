from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest

from techmine.llm import whitening as wh
from tests.conftest import SF001


def expected(rows):
    """Brute force: exact integer covariance, eigenvectors of the whole matrix."""
    kept = [(i, [floor(Fraction(float(c)) * 64) + 1000000 for c in v]) for i, v in rows
            if v and all(c is not None and isfinite(c) for c in v)]
    n, d = len(kept), len(kept[0][1])
    sums = [sum(x[j] for _, x in kept) for j in range(d)]
    dev = [[n * x[j] - sums[j] for j in range(d)] for _, x in kept]
    cov = np.array([[float(Fraction(sum(r[a] * r[b] for r in dev), n ** 3)) for b in range(d)] for a in range(d)])
    e, v = np.linalg.eigh(cov)
    return kept, n, dev, e[::-1], v[:, ::-1].T, float(np.trace(cov))


def check(rows, out, most=32):
    kept, n, dev, e, v, trace = expected(rows)
    k = min(most, int((e > e[0] * 1e-18).sum()) if e[0] > 0 else 0)
    by = {}
    for r in out:
        assert r.n == n
        by.setdefault(r.vec_id, {})[r.component] = r
    assert set(by) == {i for i, _ in kept}
    ks = {tuple(sorted(c)) for c in by.values()}
    assert len(ks) == 1
    count = len(next(iter(ks)))
    assert next(iter(ks)) == tuple(range(1, count + 1)) and count <= k
    y = np.array([[float(Fraction(x, n)) for x in r] for r in dev])
    w = np.array([[by[i][c].whitened for c in range(1, count + 1)] for i, _ in kept])
    for c in range(count):
        rs = [by[i][c + 1] for i, _ in kept]
        assert rs[0].explained == pytest.approx(e[c] / trace, rel=1e-6)
        gap = min([abs(e[c] - e[j]) for j in range(len(e)) if j != c] or [e[c]])
        if gap > 1e-6 * e[0]:
            want = y @ v[c] / np.sqrt(e[c])
            sign = np.sign(want @ w[:, c])
            assert np.abs(sign * w[:, c] - want).max() < 1e-6 * max(1, np.abs(want).max())
    assert np.abs(w.T @ w / n - np.eye(count)).max() < 1e-4
    assert all(r.identity_error < 1e-4 for r in out)
    for (i, _), r in zip(kept, dev):
        assert by[i][1].deviation == sum(x * x for x in r)
    return count


def table(spark, rows):
    return spark.createDataFrame([(i, v, "clash", "clash") for i, v in rows],
                                 "vec_id long, embedding array<float>, id string, n string")


def test_given_table(spark):
    df = spark.read.parquet(f"{SF001}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert check(rows, wh.whitened(df).collect()) == 32


@pytest.mark.parametrize("kind", ["wide", "ill", "offset", "rank", "few"])
def test_hard_matrices(spark, kind):
    r = np.random.default_rng(3)
    x = r.normal(size=(300, 12))
    if kind == "ill":     # a hundred thousand times as wide in one direction as in another
        x = x * np.logspace(4, -1, 12)
        x[:, 1] += x[:, 0]
    if kind == "offset":  # far from the origin
        x = x + 30000.0
    if kind == "rank":    # constant, repeated and summed dimensions
        x = np.round(x * 640) / 64
        x[:, 3], x[:, 4], x[:, 5] = 7.0, x[:, 0], x[:, 1] + x[:, 2]
    if kind == "few":     # fewer vectors than dimensions
        x = x[:6]
    rows = [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate(x)]
    count = check(rows, wh.whitened(table(spark, rows).repartition(7)).collect())
    assert count == {"rank": 9, "few": 5}.get(kind, 12)


def test_edge_rows(spark):
    r = np.random.default_rng(4)
    nan, inf = float("nan"), float("inf")
    good = [(k, [float(np.float32(c)) for c in v]) for k, v in enumerate(r.normal(size=(40, 3)) * 5)]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [nan, 1.0, 1.0]), (103, [1.0, -inf, 1.0]), (104, [])]
    other = [(105, [1.0]), (106, [1.0, 2.0]), (107, [1e30, 0.0, 0.0])]
    df = table(spark, good[:20] + bad + other + good[20:] + [(5, good[5][1]), (None, [9.0, 9.0, 9.0])])
    rows = good + [(5, good[5][1]), (None, [9.0, 9.0, 9.0])]
    out = wh.whitened(df)
    got = out.collect()
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(rows, got)
    assert len(got) == 3 * len(rows)


def test_nothing_varies(spark):
    assert wh.whitened(table(spark, [])).count() == 0
    assert wh.whitened(table(spark, [(1, None), (2, [])])).count() == 0
    assert wh.whitened(table(spark, [(1, [2.0, 3.0])])).count() == 0
    assert wh.whitened(table(spark, [(k, [2.0, 3.0]) for k in range(5)])).count() == 0
    one = wh.whitened(table(spark, [(k, [2.0, float(k)]) for k in range(5)])).collect()
    assert {r.component for r in one} == {1} and one[0].explained == pytest.approx(1)


def test_passes_repeat_until_orthonormal():
    r = np.random.default_rng(5)
    y = r.normal(size=(500, 10)) @ np.diag(np.logspace(0, -7, 10)) @ r.normal(size=(10, 10))
    factors, passes = wh.triangular_factors(lambda fs: (lambda q: q.T @ q)(wh.solved(y, fs)), *y.shape)
    q = wh.solved(y, factors[:-1])
    assert passes >= 3 and np.abs(q.T @ q - np.eye(10)).max() < 1e-12
    full = factors[0]
    for f in factors[1:]:
        full = f @ full
    assert np.allclose(np.linalg.svd(full)[1], np.linalg.svd(y)[1], rtol=1e-8)


def test_wide_numbers():
    c = wh.Centre(10 ** 12, np.array([10 ** 18, 5 * 10 ** 17 + 1]))
    x = np.array([[1000003, 500000], [1 << 51, 0]])
    y = c.centred(x)
    assert y[0, 0] == 3.0 and abs(y[0, 1] + 1e-12) < 1e-14
    big = wh.Centre(10 ** 9, np.array([0, 0]))
    assert big.deviations(np.array([[10 ** 6, 1], [1, 1]])).to_pylist() == [None, 2 * 10 ** 18]
