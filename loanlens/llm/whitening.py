"""Embedding whitening by spectrum slicing.

The covariance of the distinct integer vectors is summed by tasks (centred before multiplying) and one
dimension x dimension matrix reaches the driver, whatever the number of rows. There the inertia of
LDL^T factorisations of the shifted matrix counts the eigenvalues above a shift: bisection on that count isolates each
leading eigenvalue, Rayleigh quotient iteration converges to its vector, and two more counts, just
below and above the value found, certify its number. Rows are projected where they are.

Defined results: vectors that are NULL, empty, hold NULL or non-finite entries or are not of the commonest length
(ties: the shorter) take no part; repeated vectors count once in the fit and all their rows are returned; repeated and
NULL ids keep their rows; equal eigenvalues are numbered in the order found, with orthogonal vectors; components whose variance is
lost in rounding (a millionth of a millionth of the total) are left out, so fewer than ``k`` come back for flat data
and none for a single vector; an empty table gives no rows; a deviation beyond 64 bits is NULL, and
so are those of entries whose square is; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, ship

K = 4
SCALE = 256
_ALPHA = (1 + math.sqrt(17)) / 8
#: Share of the total variance below which a component is rounding noise.
NOISE = 1e-12


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, x``: the integer vectors of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select("vec_id", v.alias("v")).where(
        F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))))
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1)
    return rows.join(F.broadcast(common.select("d")), F.size("v") == F.col("d"), "left_semi").select(
        "vec_id", F.transform("v", lambda c: F.floor(c * SCALE)).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def moments(fit: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """Rows, exact sums and covariance (divisor n) of the vectors ``x`` of a frame."""
    at = fit.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(
        F.count("*").alias("n"), F.sum(F.col("c").cast("decimal(38,0)")).alias("s")).collect()  # a row per dimension
    if not at:
        return 0, [], np.zeros((0, 0))
    n, sums = at[0]["n"], [int(r["s"]) for r in sorted(at, key=lambda r: r["i"])]
    d, mean = len(sums), np.array([s / n for s in sums])
    low = np.tril_indices(d)

    def run(batches):
        total = np.zeros((d, d))
        for batch in batches:
            x = _matrix(batch.column(0)).astype(np.float64)
            if len(x):
                x -= mean
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(low[0], pa.int32()), pa.array(low[1], pa.int32()), pa.array(total[low])],
                                         names=["i", "j", "v"])
    got = fit.select("x").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    v = np.zeros((d, d))                                # a row per pair of dimensions
    v[np.asarray(got["i"]), np.asarray(got["j"])] = np.asarray(got["v"]) / n
    return n, sums, v + np.tril(v, -1).T


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix exceed ``shift``: positive pivots of its LDL^T factors.

    Complete pivoting with blocks of one or two; a block of two has one positive and one negative
    eigenvalue.
    """
    a = matrix - shift * np.eye(len(matrix))
    count = 0
    while len(a):
        off = np.abs(a - np.diag(np.diag(a)))
        r = int(np.argmax(np.abs(np.diag(a))))
        if abs(a[r, r]) >= _ALPHA * off.max():
            if a[r, r] == 0:
                return count                            # nothing but zeros is left
            count += a[r, r] > 0
            rest = np.arange(len(a)) != r
            w = a[rest, r]
            a = a[np.ix_(rest, rest)] - np.outer(w, w / a[r, r])
        else:
            p, q = np.unravel_index(int(np.argmax(off)), off.shape)
            count += 1
            rest = np.ones(len(a), bool)
            rest[[p, q]] = False
            w = a[np.ix_(rest, [p, q])]
            a = a[np.ix_(rest, rest)] - w @ np.linalg.solve(a[np.ix_([p, q], [p, q])], w.T)
    return int(count)


def _solve(matrix: np.ndarray, shift: float, x: np.ndarray, scale: float) -> np.ndarray:
    try:
        return np.linalg.solve(matrix - shift * np.eye(len(x)), x)
    except np.linalg.LinAlgError:                       # the shift is an eigenvalue to the last bit
        return np.linalg.solve(matrix - (shift + 4 * np.finfo(float).eps * scale) * np.eye(len(x)), x)


def leading(matrix: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues above the noise, falling, and their unit vectors (rows)."""
    d = len(matrix)
    total = float(np.trace(matrix)) if d else 0.0
    values, vectors = [], []
    if total <= 0:
        return np.zeros(0), np.zeros((0, d))
    radius = float(np.abs(matrix).sum(1).max())         # no eigenvalue is larger
    tight = 8 * d * np.finfo(float).eps * radius
    rng = np.random.default_rng(0)
    for m in range(1, min(k, d) + 1):
        # above(low) >= m > above(high): the m-th largest lies between
        low, high = -tight, radius + tight
        if values:
            high = min(high, values[-1] + tight)
        below, over = above(matrix, low), above(matrix, high)
        while high - low > tight and not (below == m and over == m - 1 and high - low < 1e-3 * max(high, tight)):
            mid = (low + high) / 2
            c = above(matrix, mid)
            low, high, below, over = (mid, high, c, over) if c >= m else (low, mid, below, c)
        found = np.array(vectors).reshape(-1, d)

        def clean(x, found=found):
            for _ in range(2):
                x = x - found.T @ (found @ x)
            return x / np.linalg.norm(x)
        x, shift = clean(rng.standard_normal(d)), (low + high) / 2
        for _ in range(3):                              # inverse iteration from inside the interval
            x = clean(_solve(matrix, shift, x, radius))
        best = None
        for _ in range(30):                             # Rayleigh quotients, kept inside the interval
            shift = float(x @ matrix @ x)
            left = float(np.linalg.norm(matrix @ x - shift * x))
            if best is None or left < best[0]:
                best = (left, shift, x)
            elif left <= tight:
                break
            x = clean(_solve(matrix, min(max(shift, low), high), x, radius))
        _, value, x = best
        room = max(tight, 2 * best[0])
        if not above(matrix, value - room) >= m > above(matrix, value + room):
            raise ArithmeticError(f"eigenvalue {m} is not certified by the inertia counts")
        if value <= NOISE * total:
            break
        values.append(value)
        vectors.append(x)
    return np.array(values), np.array(vectors).reshape(-1, d)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of (n x - S)^2 as n^2 sum(x^2) - 2 n sum(x S) + sum(S^2); None beyond 64 bits."""
    d, top, most = x.shape[1], max(int(x.max()), -int(x.min())), max(abs(s) for s in sums)
    wide = d * max(top, 1) * max(top, most, 1) >= 1 << 63
    y, s = (x.astype(object), np.array(sums, object)) if wide else (x, np.array(sums, np.int64))
    square, cross, own = (y * y).sum(1), (y * s).sum(1), sum(v * v for v in sums)
    out = (n * n * int(a) - 2 * n * int(b) + own for a, b in zip(square, cross, strict=True))
    return [v if v < 1 << 63 else None for v in out]


def whiten(vectors: DataFrame, k: int = K) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per row and component."""
    ship(vectors.sparkSession)
    rows = cut_lineage(usable(vectors))
    fit = cut_lineage(rows.select("x").distinct())
    n, sums, cov = moments(fit)
    values, axes = leading(cov, k)
    mean, root = np.array([s / n for s in sums]) if n else np.zeros(0), np.sqrt(values)

    def project(x: np.ndarray) -> np.ndarray:
        return (x - mean) @ axes.T / root

    def spread(batches):
        total = np.zeros((len(root), len(root)))
        for batch in batches:
            if len(batch):
                w = project(_matrix(batch.column(0)))
                total += w.T @ w
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())],
                                         names=["i", "j", "v"])
    error = fit.mapInArrow(spread, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).agg(
        F.max(F.abs(F.col("v") / n - (F.col("i") == F.col("j")).cast("double")))).first()[0] if len(root) else 0.0
    share = values / np.trace(cov) if len(root) else values

    def run(batches):
        for batch in batches:
            m, p = len(batch), len(root)
            if not m or not p:
                continue
            x = _matrix(batch.column(1))
            owner = pa.array(np.repeat(np.arange(m), p))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(owner), pa.array(np.tile(np.arange(1, p + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * p, n)), pa.array(_deviations(x, n, sums), pa.int64()).take(owner),
                 pa.array(project(x).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * p, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.select("vec_id", "x").mapInArrow(
        run, f"vec_id {dict(rows.dtypes)['vec_id']}, component int, n long, deviation long, whitened double, "
             "explained double, identity_error double")
