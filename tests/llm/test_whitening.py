"""Embedding whitening against a dense eigenvalue routine, exact integers and odd rows."""

import math

import numpy as np
import pytest

from loanlens.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, n int, component string, v int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "c", 1) for i, v in rows], SCHEMA).repartition(3)


def check(rows, got, k=4):
    """``got`` against numpy; ``rows``: the usable (id, vector)."""
    xs = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows]
    fit = sorted({tuple(x) for _, x in xs})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    a = np.array(fit, float)
    a -= np.array(sums) / n
    cov = a.T @ a / n
    values = np.linalg.eigh(cov)[0][::-1][:k]
    assert len(got) == len(rows) * len(values)
    assert {r["n"] for r in got} == {n} and max(r["identity_error"] for r in got) < 1e-8
    want = sorted((i or -1, m, sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))) for i, x in xs for m in range(1, len(values) + 1))
    assert sorted((r["vec_id"] or -1, r["component"], r["deviation"]) for r in got) == want
    for m, e in enumerate(values, 1):
        mine = [r for r in got if r["component"] == m]
        assert all(abs(r["explained"] - e / np.trace(cov)) < 1e-12 for r in mine)
        vec = np.linalg.eigh(cov)[1][:, -m]
        by = {}
        for i, x in xs:
            by.setdefault(i, []).append((np.array(x) - np.array(sums) / n) @ vec / math.sqrt(e))
        sign = 1 if sum(r["whitened"] * by[r["vec_id"]][0] for r in mine) > 0 else -1
        for i, w in by.items():
            assert np.allclose(sorted(r["whitened"] for r in mine if r["vec_id"] == i), sorted(sign * np.array(w)), atol=1e-7)


def vectors(d=9, n=150):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((n, d)) * np.linspace(2, 0.1, d)
    return [(i, [float(c) for c in row]) for i, row in enumerate(x)]


def test_whitening_and_odd_rows(spark):
    rows = vectors()
    rows += [(900, rows[3][1]), (901, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (902, [-0.0] * 9)]
    odd = [(950, None), (951, []), (952, [1.0, None] + [0.0] * 7), (953, [float("nan")] * 9), (954, [float("inf")] * 9), (955, [1.0, 2.0])]
    out = whitening.whiten(frame(spark, rows + odd))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(rows, out.collect())


def test_flat_single_and_empty(spark):
    line = [(i, [float(i), 2.0 * i, 1.0]) for i in range(12)]
    got = whitening.whiten(frame(spark, line)).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 12 and abs(got[0]["explained"] - 1) < 1e-12
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(frame(spark, [])).count() == 0


def test_large_entries(spark):
    rows = [(1, [1e15, 0.0]), (2, [-1e15, 1.0]), (3, [3.0, 4.0]), (4, [1e30, 2.0])]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r["vec_id"] for r in got} == {1, 2, 3, 4} and all(r["deviation"] is None for r in got)


def test_driver_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(rows, queries.op13_embedding_whitening(spark, sf).collect())


@pytest.mark.parametrize("d", [1, 2, 5, 40])
def test_inertia_counts(d):
    rng = np.random.default_rng(d)
    for _ in range(20):
        a = rng.standard_normal((d, d))
        a = a + a.T
        e = np.linalg.eigvalsh(a)
        for shift in [*((e[1:] + e[:-1]) / 2), e[0] - 1, e[-1] + 1, 0.0]:
            assert whitening.above(a, shift) == int((e > shift).sum())


@pytest.mark.parametrize("spectrum", [[5, 5, 5, 1, 0, 0], [3, 3 - 1e-9, 2, 1, 1, 1], [1e-6, 1e-7, 0, 0, 0, 0], [2, 0, 0, 0, 0, 0],
                                      [1, 1, 1, 1, 1, 1], [9, 4, 3, 2.9999, 1, 0.5]])
def test_leading_of_tied_and_flat_spectra(spectrum):
    q = np.linalg.qr(np.random.default_rng(6).standard_normal((6, 6)))[0]
    a = (q * spectrum) @ q.T
    a = (a + a.T) / 2
    e, v = whitening.leading(a, 4)
    kept = [s for s in sorted(spectrum, reverse=True)[:4] if s > 1e-11 * sum(spectrum)]
    assert len(e) == len(kept) and np.allclose(e, kept, rtol=1e-9)
    assert np.allclose(v @ v.T, np.eye(len(e)), atol=1e-9) and np.allclose(a @ v.T, v.T * e, atol=1e-10 * max(spectrum))
