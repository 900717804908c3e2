import math
import random

import numpy as np
import pytest

from txpipe.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, i int, v string, n string"


def table(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, v, 0, 1, "x", "y") for i, v in enumerate(vectors)], SCHEMA)


def brute(vectors, width):
    x = np.array([[math.floor(64.0 * float(np.float32(c))) + 1_000_000 for c in (v + [0.0] * (width - len(v)))] for v in vectors], object)
    n, s = len(x), x.sum(axis=0)
    z = (x * n - s).astype(np.float64) / n
    v = z.T @ z / n
    return x, n, s, z, v


def check(df, vectors, width, spare=0):
    x, n, s, z, v = brute(vectors, width)
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    k = min(32, int((e > W.LEAST * e.sum()).sum()))
    rows = df.collect()
    assert len(rows) == n * k + spare
    got = {(r["vec_id"], r["component"]): r for r in rows}
    for i in range(n):
        dev = sum(int(d) ** 2 for d in x[i] * n - s)
        for c in range(1, k + 1):
            r = got[i, c]
            assert (r["n"], r["deviation"]) == (n, dev)
            assert r["explained"] == pytest.approx(e[c - 1] / e.sum(), rel=1e-9)
            assert r["identity_error"] < 1e-8
    w = np.array([[got[i, c]["whitened"] for c in range(1, k + 1)] for i in range(n)])
    want = z @ q[:, :k] / np.sqrt(e[:k])
    gaps = np.append(-np.diff(e), 1)[:k]
    for c in range(k):  # eigenvectors of eigenvalues that stand apart, up to their sign
        if gaps[c] > 1e-6 * e[0] and (c == 0 or gaps[c - 1] > 1e-6 * e[0]):
            assert min(np.abs(w[:, c] - want[:, c]).max(), np.abs(w[:, c] + want[:, c]).max()) < 1e-6
    assert np.abs(np.cov(w.T, bias=True) - np.eye(k)).max() < 1e-8


def test_equals_a_dense_solver(spark):
    rng = np.random.default_rng(1)
    vectors = (rng.standard_normal((200, 40)) * rng.uniform(0.1, 3, 40)).tolist()
    check(W.whitened(table(spark, vectors).repartition(5)), vectors, 40)


def test_rows_that_take_no_part_short_vectors_and_null_ids(spark):
    rng = random.Random(2)
    vectors = [[rng.gauss(0, 1) for _ in range(rng.choice([0, 3, 5]))] for _ in range(60)]
    odd = spark.createDataFrame([(900, None, 0, 1, "x", "y"), (901, [1.0, None], 0, 1, "x", "y"), (902, [float("nan")], 0, 1, "x", "y"), (903, [float("inf"), 1.0], 0, 1, "x", "y")], SCHEMA)
    check(W.whitened(table(spark, vectors).union(odd)), vectors, 5)
    nameless = W.whitened(spark.createDataFrame([(None, [1.0, 2.0], 0, 1, "x", "y"), (1, [0.0, 5.0], 0, 1, "x", "y"), (1, [0.0, 5.0], 0, 1, "x", "y")], SCHEMA)).collect()
    assert [r["vec_id"] for r in nameless].count(None) == 1 and [r["vec_id"] for r in nameless].count(1) == 2 and all(r["n"] == 3 for r in nameless)


def test_no_variance_no_rows(spark):
    assert W.whitened(table(spark, [])).count() == 0
    assert W.whitened(table(spark, [[1.0, 2.0]])).count() == 0
    assert W.whitened(table(spark, [[1.0, 2.0]] * 9)).count() == 0
    assert W.whitened(table(spark, [[], []])).count() == 0


def test_equal_eigenvalues_and_low_rank(spark):
    cube = [[float(b >> i & 1) for i in range(6)] for b in range(64)]  # covariance is a multiple of the identity
    check(W.whitened(table(spark, cube)), cube, 6)
    rng = np.random.default_rng(3)
    flat = [[float(a), float(b), float(a), 7.0] for a, b in rng.integers(-9, 9, (50, 2))]  # two of four dimensions
    check(W.whitened(table(spark, flat)), flat, 4)


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(4)
    vectors = (rng.standard_normal((30, 3)) * 1e9).astype(np.float32).astype(float).tolist()
    x, n, s, _, _ = brute(vectors, 3)
    for r in W.whitened(table(spark, vectors)).collect():
        assert r["deviation"] == min(sum(int(d) ** 2 for d in x[r["vec_id"]] * n - s), 2**63 - 1)
        assert r["identity_error"] < 1e-6
    z = rng.integers(-(1 << 41), 1 << 41, (50, 4))
    assert (W._products(z) == z.astype(object).T @ z.astype(object)).all()


@pytest.mark.parametrize("seed", range(8))
def test_counts_and_pairs_of_matrices(seed):
    rng = np.random.default_rng(seed)
    d = int(rng.integers(1, 30))
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    e = np.sort(rng.choice([1.0, 1.0 + 1e-9, 2.0, 5.0, 1e-3, 40.0], d) if seed % 2 else rng.uniform(0, 9, d))[::-1]
    v = (q * e) @ q.T
    v = (v + v.T) / 2
    for shift in rng.uniform(-1, 10, 5):
        assert W.pivots_above(v, shift) == (np.linalg.eigvalsh(v) > shift).sum()
    zero = np.array([[0.0, 1.0], [1.0, 0.0]])
    assert W.pivots_above(zero, 0.0) == 1
    got, p = W.leading(v, 10)
    k = len(got)
    assert k == min(d, 10) and np.allclose(got, e[:k], atol=1e-12 * e[0]) and np.allclose(p.T @ p, np.eye(k), atol=1e-12)
    assert np.abs(v @ p - p * got).max() < 1e-12 * e[0] * d
