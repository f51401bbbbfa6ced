"""Whitening against numpy on exact covariances, and on odd vectors."""

from __future__ import annotations

import math

import numpy as np
import pytest

from sensorlake.llm import whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, at int"


def brute(vectors):
    """Distinct whole vectors, their sums, and the eigenpairs of their covariance."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    distinct = np.array(sorted({tuple(v) for v in x}))
    n, sums = len(distinct), distinct.sum(0)
    centred = distinct - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return x, n, sums, values[::-1], axes[:, ::-1].T


def check(rows, vectors, ids, components):
    x, n, sums, values, axes = brute(vectors)
    got = {}
    for r in rows:
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert len(rows) == len(vectors) * components
    found = np.array([[got[i][k + 1]["whitened"] for k in range(components)] for i in ids])
    want = ((np.array(x) - sums / n) @ axes[:components].T) / np.sqrt(values[:components])
    signs = np.sign((found * want).sum(0))
    assert np.abs(found - want * signs).max() < 1e-6
    trace = values.sum()
    for i, v in zip(ids, x):
        r = got[i][1]
        assert r["n"] == n
        assert r["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums))
        assert r["explained"] == pytest.approx(values[0] / trace, rel=1e-9)
        assert r["identity_error"] < 1e-9


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check(whitening.op11_whitening(spark, SF).collect(), [r["embedding"] for r in rows], [r["vec_id"] for r in rows], 16)


def test_small_eigenvalues_keep_their_digits(spark):
    rng = np.random.default_rng(5)
    wide = rng.normal(size=(400, 3)) * np.array([1e6, 1e3, 1.0])
    vectors = [[float(np.float32(c)) for c in v] for v in wide]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    got = whitening.embedding_whitening(rows).collect()
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors])
    n = len(x)
    y = x - x.sum(0) // n
    exact = [[n * sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) - int(y[:, i].sum()) * int(y[:, j].sum()) for j in range(3)] for i in range(3)]
    values = np.linalg.eigvalsh(np.array([[v / n**2 for v in r] for r in exact]))[::-1]
    found = {r["component"]: r["explained"] for r in got}
    for k in range(3):
        assert found[k + 1] == pytest.approx(values[k] / values.sum(), rel=1e-4 if k == 2 else 1e-9)
    assert got[0]["identity_error"] < 1e-6


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, 1.0], 3, "keep", 9), (2, [1.5, -1.0], 3, "keep", 9), (3, [0.5, 1.0], 3, "copy", 9), (None, [0.25, 2.0], 0, None, None),
        (4, None, 0, None, 0), (5, [None, 1.0], 0, None, 0), (6, [nan, 1.0], 0, None, 0), (7, [inf, 1.0], 0, None, 0),
        (8, [], 0, None, 0), (9, [1.0, 2.0, 3.0], 0, None, 0), (2, [1.5, -1.0], 3, "again", 9),
    ]
    got = whitening.embedding_whitening(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in got) == sorted((i, k) for i in (0, 1, 2, 2, 3) for k in (1, 2))
    by = {(r["vec_id"], r["component"]): r for r in got}
    assert by[1, 1]["whitened"] == by[3, 1]["whitened"] and by[1, 1]["n"] == 3
    assert set(got[0].asDict()) == {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}


def test_rank_and_empty(spark):
    flat = [(i, [float(i), 2.0 * i, 1.0], 0, "", 0) for i in range(10)]
    got = whitening.embedding_whitening(spark.createDataFrame(flat, SCHEMA)).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 10
    assert got[0]["explained"] == pytest.approx(1.0)
    assert whitening.embedding_whitening(spark.createDataFrame([(1, [1.0, 2.0], 0, "", 0)] * 3, SCHEMA)).collect() == []
    assert whitening.embedding_whitening(spark.createDataFrame([], SCHEMA)).collect() == []


def test_huge_entries_stay_exact(spark):
    rows = [(i, [float(i) * 2.0**30, 1.0, -float(i * i)], 0, "", 0) for i in range(1, 8)]
    got = whitening.embedding_whitening(spark.createDataFrame(rows, SCHEMA)).collect()
    x = [[min(math.floor(64 * c), 1 << 40) + 1_000_000 for c in v] for _, v, *_ in rows]
    sums = [sum(c) for c in zip(*x)]
    want = [sum((7 * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    assert {(r["vec_id"], r["deviation"]) for r in got} == {(i, w if w < 2**63 else None) for (i, *_), w in zip(rows, want)}


def test_factor_and_rotations():
    rng = np.random.default_rng(2)
    for d, rank in ((1, 1), (5, 5), (9, 4)):
        a = rng.normal(size=(d, rank)).astype(np.longdouble)
        lower, order = whitening.pivoted_cholesky(a @ a.T)
        assert lower.shape == (d, rank)
        assert np.allclose((lower @ lower.T).astype(float), (a @ a.T)[np.ix_(order, order)].astype(float), atol=1e-12)
        turned = whitening.one_sided_jacobi(lower)
        gram = (turned.T @ turned).astype(float)
        assert np.allclose(gram, np.diag(np.diag(gram)), atol=1e-12 * np.abs(gram).max())
        assert np.allclose(np.sort(np.diag(gram)), np.linalg.eigvalsh((a @ a.T).astype(float))[-rank:], rtol=1e-8)
