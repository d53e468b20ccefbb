"""Whitening by FEAST against numpy's dense eigensolver and exact integers."""

import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from orderlake.llm import whitening

SF = "/root/testdata/sf0.001"


def brute(vectors, k):
    x = np.floor(64.0 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    v = c.T @ c / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return n, [sum((n * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in x], e, c @ q / np.sqrt(e), np.trace(v)


def compare(rows, ids, vectors, k):
    n, deviation, e, white, trace = brute(vectors, k)
    at = {i: j for j, i in enumerate(ids)}
    got = np.zeros((n, k))
    for r in rows:
        j = at[r["vec_id"]]
        got[j, r["component"] - 1] = r["whitened"]
        assert r["n"] == n and int(r["deviation"]) == deviation[j]
        assert math.isclose(r["explained"], e[r["component"] - 1] / trace, rel_tol=1e-9)
        assert r["identity_error"] < 1e-9
    assert len(rows) == n * k
    for j in range(k):
        sign = np.sign(got[:, j] @ white[:, j])
        assert np.abs(got[:, j] * sign - white[:, j]).max() < 1e-6


def test_given_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    t = pq.read_table(f"{SF}/embeddings.parquet").to_pydict()
    keep = [(i, v) for i, v in zip(t["vec_id"], t["embedding"]) if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    compare(whitening.whiten(df).collect(), [i for i, _ in keep], [v for _, v in keep], 32)


def test_odd_rows(spark):
    rows = [(1, [1.0, 2.0], "a"), (2, None, "b"), (3, [1.0, None], "c"), (4, [float("nan"), 0.0], "d"), (5, [float("inf"), 1.0], "e"),
            (6, [3.0, -1.0], None), (7, [0.5, 0.25], "x"), (8, [1.0, 2.0, 3.0], "x"), (9, [], "x"), (None, [9.0, 1.0], "y")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, component string")
    got = whitening.whiten(df).collect()
    compare(got, [1, 6, 7, None], [[1, 2], [3, -1], [0.5, 0.25], [9, 1]], 2)


def test_no_variance(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 5, schema)).collect() == []
    flat = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], schema)).collect()
    assert {r["component"] for r in flat} == {1}


@pytest.mark.parametrize("spectrum", [[5.0] * 40, [10.0 ** -i for i in range(9)] + [0.0] * 31, list(range(1, 41)), [1.0] * 20 + [1.0 + 1e-7] * 20])
def test_leading_against_dense(spark, spectrum):
    q = np.linalg.qr(np.random.default_rng(1).standard_normal((40, 40)))[0]
    v = q @ np.diag(spectrum) @ q.T
    v = (v + v.T) / 2
    e, x = whitening.leading(spark, v, 12)
    want = np.sort(spectrum)[::-1][:12]
    want = want[want > 0]
    assert len(e) >= len(want) and np.allclose(e[: len(want)], want, atol=1e-12 * max(spectrum) * 40)
    assert np.abs(x.T @ x - np.eye(x.shape[1])).max() < 1e-12
    assert np.abs(v @ x - x * e).max() < 1e-9 * max(spectrum)


def test_inertia():
    random = np.random.default_rng(3)
    for _ in range(40):
        a = random.standard_normal((9, 9))
        a = a + a.T
        for sigma in random.standard_normal(3) * 3:
            assert whitening.above(a, sigma) == int((np.linalg.eigvalsh(a) > sigma).sum())
    zero = np.array([[0.0, 1.0], [1.0, 0.0]])
    assert whitening.above(zero, 0.0) == 1


def test_large_deviation(spark):
    """Beyond 64-bit integers the deviation stays exact."""
    big = 2.0**40
    df = spark.createDataFrame([(i, [big * i, 1.0]) for i in range(4)], "vec_id long, embedding array<double>")
    n, deviation, *_ = brute([[big * i, 1.0] for i in range(4)], 1)
    x = [[int(64 * big * i) + 1_000_000, 1_000_064] for i in range(4)]
    s = [sum(c) for c in zip(*x)]
    want = {i: sum((4 * a - b) ** 2 for a, b in zip(r, s)) for i, r in enumerate(x)}
    assert {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(df).collect()} == want
