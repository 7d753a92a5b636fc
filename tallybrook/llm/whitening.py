"""Embedding whitening by matrix-free block subspace iteration (operator 13).

Vectors become whole numbers. The fit list, each distinct vector once, gives n and the exact sum S and sum of squares of
each dimension. The covariance V is never formed: a Spark pass computes V Q = X'(X Q) / n for a narrow block Q, on rows
centred by S / n before anything is multiplied. A task adds up its rows' products, and Spark adds up the tasks' entries,
so the driver sees a block of as many numbers as Q has. QR makes the next block orthonormal to all before it, and
Rayleigh-Ritz over the blocks held, whose products are known, gives the best eigenpairs of their span; when `basis`
columns are held, the iteration restarts from the leading ones. It ends when the residual |V u - e u| of each of the k
components is below `tolerance` of the largest eigenvalue, or the span is the whole space. A last pass measures the
covariance of the whitened fit list.

Defined results: vectors that are null, or hold null or non-finite entries, take no part; rows without an id and
repeated rows stay, each with its components; vectors of another length are whitened among themselves; a component
without variance (a constant, or fewer distinct vectors than components) has explained 0 and no whitened value, and
takes no part in identity_error; equal eigenvalues share their space, in which any orthonormal choice may come out;
empty vectors have no component; an empty table gives an empty result; further columns don't matter, whatever their
names. An entry of 2^53 or more once scaled stops the query, as no double holds it exactly.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import matrix_of, whole_vectors, write_table

RESULT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
#: A component has no variance if its eigenvalue is below this part of the largest one.
VOID = 1e-13
MOST_PASSES = 2000


def _moments(batches):
    """n, and for each dimension the sum and the sum of squares, exactly."""
    n, sums, squares = 0, 0, 0
    for batch in batches:
        x = matrix_of(batch.column(0))
        top = int(np.abs(x).max(initial=0))
        x = x if top * top * len(x) < 1 << 62 else x.astype(object)
        n, sums, squares = n + len(x), sums + x.sum(0).astype(object), squares + (x * x).sum(0).astype(object)
    if n:
        exact = lambda xs: pa.array([Decimal(int(v)) for v in xs], pa.decimal128(38, 0))
        yield pa.record_batch([pa.array(range(len(sums)), pa.int32()), pa.array([n] * len(sums)), exact(sums), exact(squares)], names=["i", "n", "s", "s2"])


def _entries(total: np.ndarray):
    i, j = np.indices(total.shape, np.int32)
    return pa.record_batch([pa.array(i.ravel()), pa.array(j.ravel()), pa.array(total.ravel())], names=["i", "j", "v"])


def _products(mean: np.ndarray, q: np.ndarray):
    """The entries of X'(X Q) of a task's centred rows."""

    def run(batches):
        total = np.zeros(q.shape)
        for batch in batches:
            x = matrix_of(batch.column(0)) - mean
            total += x.T @ (x @ q)
        yield _entries(total)

    return run


def _spread(mean: np.ndarray, axes: np.ndarray):
    """The entries of W'W of a task's whitened rows W, and their sums as one more row."""

    def run(batches):
        total = np.zeros((axes.shape[1] + 1, axes.shape[1]))
        for batch in batches:
            w = (matrix_of(batch.column(0)) - mean) @ axes
            total += np.vstack([w.T @ w, w.sum(0)])
        yield _entries(total)

    return run


def _gathered(rows: DataFrame, run, shape: tuple[int, int]) -> np.ndarray:
    out = np.zeros(shape)
    for r in rows.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # as many as Q has entries
        out[r["i"], r["j"]] = r["v"]
    return out


def orthonormal(z: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span z outside the basis; what lies in it is left out."""
    size = np.linalg.norm(z, axis=0).max(initial=0)
    for _ in range(2):
        z = z - basis @ (basis.T @ z)
    u, s, _ = np.linalg.svd(z, full_matrices=False)
    q = u[:, s > 1e-12 * size]
    return np.linalg.qr(q - basis @ (basis.T @ q))[0]


def leading_pairs(times, d: int, k: int, block: int, basis: int, tolerance: float) -> tuple[np.ndarray, np.ndarray, int]:
    """The k largest eigenvalues of a symmetric matrix, unit eigenvectors as columns, and the passes taken. times(Q): the
    matrix times Q."""
    held, known = np.zeros((d, 0)), np.zeros((d, 0))
    rng = np.random.default_rng(13)
    q, passes = np.linalg.qr(rng.standard_normal((d, min(block, d))))[0], 0
    while passes < MOST_PASSES:
        z = times(q)
        passes += 1
        held, known = np.hstack([held, q]), np.hstack([known, z])
        h = held.T @ known
        e, y = (a[..., ::-1] for a in np.linalg.eigh((h + h.T) / 2))
        pairs, images = held @ y, known @ y
        errors = images - pairs * e
        worst = np.linalg.norm(errors[:, :k], axis=0).max(initial=0)
        if held.shape[1] >= d or worst <= tolerance * max(e[0], 0):
            return e[:k], pairs[:, :k], passes
        if held.shape[1] + block > basis:
            keep = max(k, basis // 2)
            held, known = np.linalg.qr(pairs[:, :keep])[0], images[:, :keep]
            known = known * np.sign((held * pairs[:, :keep]).sum(0))
        room = min(block, d - held.shape[1])
        q = orthonormal(errors[:, :room], held)
        if q.shape[1] < room:  # some residuals vanish; other directions may still hold larger pairs
            q = np.hstack([q, orthonormal(rng.standard_normal((d, room - q.shape[1])), np.hstack([held, q]))])
    raise RuntimeError(f"no convergence in {MOST_PASSES} passes")


def square_sums(y: np.ndarray) -> list[int]:
    """The exact sum of squares of each row of long or unbounded integers."""
    top = max(abs(int(y.max(initial=0))), abs(int(y.min(initial=0))))
    if y.dtype == object or top >= 1 << 52 or y.shape[1] >= 128:
        return [sum(v * v for v in row) for row in y.tolist()] if top * top * y.shape[1] >= 1 << 62 else (y * y).sum(1).tolist()
    high, low = y >> 24, y & ((1 << 24) - 1)
    return [(a << 48) + (b << 25) + c for a, b, c in zip((high * high).sum(1).tolist(), (high * low).sum(1).tolist(), (low * low).sum(1).tolist())]


def _results(n: int, sums: list[int], mean: np.ndarray, axes: np.ndarray, explained: np.ndarray, error: float):
    """A row for each vector and component."""
    k = axes.shape[1]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = matrix_of(part.column(1))
                wide = n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, sums), default=0) >= 1 << 62
                centred = n * (x.astype(object) if wide else x) - np.array(sums, object if wide else np.int64)
                deviation = np.repeat(np.array([Decimal(v) for v in square_sums(centred)], object), k)
                w = ((x - mean) @ axes).ravel()
                rows = len(x) * k
                yield pa.record_batch(
                    [
                        part.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(rows, n)),
                        pa.array(deviation, pa.decimal128(38, 0)), pa.array(w, mask=np.isnan(w)), pa.array(np.tile(explained, len(x))), pa.array(np.full(rows, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def _whitened(rows: DataFrame, fit: DataFrame, d: int, k: int, block: int, basis: int, tolerance: float) -> DataFrame:
    """Of vectors of one length."""
    found = fit.mapInArrow(_moments, "i int, n long, s decimal(38,0), s2 decimal(38,0)").groupBy("i").agg(*(F.sum(c).alias(c) for c in ("n", "s", "s2"))).orderBy("i").collect()  # a row per dimension
    n, sums, squares = found[0]["n"], [int(r["s"]) for r in found], [int(r["s2"]) for r in found]
    mean = np.array([s / n for s in sums])  # of integers: rounded once
    trace = sum(n * s2 - s * s for s, s2 in zip(sums, squares)) / (n * n)
    e, u, _ = leading_pairs(lambda q: _gathered(fit, _products(mean, q), q.shape) / n, d, min(k, d), block, basis, tolerance)
    some = e > VOID * max(e[0], 0)
    axes = np.where(some, u / np.sqrt(np.where(some, e, 1)), np.nan)
    sound = axes[:, some]
    error = 0.0
    if sound.shape[1]:
        got = _gathered(fit, _spread(mean, sound), (sound.shape[1] + 1, sound.shape[1]))
        means = got[-1] / n
        error = float(np.abs(got[:-1] / n - np.outer(means, means) - np.eye(sound.shape[1])).max())
    explained = np.where(some, e / trace if trace else 0.0, 0.0)
    return rows.mapInArrow(_results(n, sums, mean, axes, explained, error), RESULT)


def whiten(vectors: DataFrame, k: int = 4, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, block: int = 16, basis: int = 128, tolerance: float = 1e-13) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row for each vector that takes
    part and each of its k leading components.

    block: columns that a pass multiplies; basis: columns held at most, at least twice the block and k.
    """
    if basis < 2 * max(block, k):
        raise ValueError("basis must be at least twice the block and k")
    rows = whole_vectors(vectors, id_col, vector_col, scale).where("dim > 0")
    fit = write_table(rows.select("dim", "x").distinct(), "fit")
    lengths = [r["dim"] for r in fit.select("dim").distinct().orderBy("dim").collect()]
    of = lambda df, d, *c: df.where(F.col("dim") == d).select(*c)
    parts = [_whitened(of(rows, d, "vec_id", "x"), of(fit, d, "x"), d, k, block, basis, tolerance) for d in lengths]
    return reduce(DataFrame.unionByName, parts) if parts else vectors.sparkSession.createDataFrame([], RESULT)
