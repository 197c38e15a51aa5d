"""Sums over sparse patient vectors that never leave their tasks as whole matrices:
the Gram matrix in entries (A12), principal components (M5), one EM step (M9).

A task walks its vectors in slices, keeps its own sums and hands them on once; the
driver gets sums whose size is that of a model (vocabulary x components), not of the
data and not vocabulary².
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Products of a task at once, and sums that it holds before it hands them on.
PRODUCTS = 1 << 20
HELD = 1 << 20
#: Columns that the iteration carries beside the wanted components, and bytes of basis.
OVERSAMPLE = 8
BASIS_BYTES = 1 << 28


def _lists(column: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    offsets = column.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0], column.flatten()


def _merged(keys: list, sums: list) -> tuple[np.ndarray, np.ndarray]:
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(at, np.concatenate(sums), len(key))


def gram_entries(entries: DataFrame, width: int) -> DataFrame:
    """``entries`` (a patient's ``(idx, value)``, sorted) → ``(i, j, s)`` with i ≤ j: the
    sums of products over all patients that have both.

    A task sums its products before they are shuffled, in slices of ``PRODUCTS``, and
    holds at most about ``HELD`` sums."""
    products, most = PRODUCTS, HELD

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums, size = [], [], 0

        def out():
            key, s = _merged(keys, sums)
            yield pa.RecordBatch.from_arrays([pa.array(key // width), pa.array(key % width), pa.array(s)],
                                             ["i", "j", "s"])

        for batch in batches:
            offsets, flat = _lists(batch.column(0))
            idx, value = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            idx = idx.astype(np.int64)
            n = np.diff(offsets)
            # an entry meets itself and those behind it in its patient's list
            meets = np.repeat(offsets[1:], n) - np.arange(len(idx))
            total = np.cumsum(meets)
            start = 0
            while start < len(idx):
                done = total[start] - meets[start]
                end = max(start + 1, int(np.searchsorted(total, done + products, "right")))
                m = meets[start:end]
                first = np.repeat(np.arange(start, end), m)
                second = first + np.arange(len(first)) - np.repeat(np.cumsum(m) - m, m)
                key, s = _merged([idx[first] * width + idx[second]], [value[first] * value[second]])
                keys.append(key)
                sums.append(s)
                size += len(key)
                start = end
                if size > most:
                    key, s = _merged(keys, sums)
                    keys, sums, size = [key], [s], len(key)
                    if size > most // 2:
                        yield from out()
                        keys, sums, size = [], [], 0
        if keys:
            yield from out()

    return (entries.select("entries").mapInArrow(run, "i long, j long, s double")
            .groupBy("i", "j").agg(F.sum("s").alias("s")))


def _sparse(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets, indices and values of a batch of ``(indices, values)``."""
    offsets, idx = _lists(batch.column(0))
    return offsets, idx.to_numpy(zero_copy_only=False), batch.column(1).flatten().to_numpy(zero_copy_only=False)


def _times(offsets, idx, value, matrix) -> np.ndarray:
    """Rows of sparse vectors times a matrix."""
    sums = np.vstack((np.zeros((1, matrix.shape[1])), np.cumsum(matrix[idx] * value[:, None], axis=0)))
    return sums[offsets[1:]] - sums[offsets[:-1]]


def second_moment_times(vectors: DataFrame, matrix: np.ndarray) -> np.ndarray:
    """Σ x xᵀ ``matrix`` over ``vectors(indices, values)``: one pass, a matrix of the same
    shape back; rows without an entry of a feature send nothing for it."""
    carried = vectors.sparkSession.sparkContext.broadcast(matrix)
    width, k = matrix.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, touched = np.zeros((width, k)), np.zeros(width, bool)
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                offsets, idx, value = _sparse(batch.slice(a, 1024))
                if not len(idx):
                    continue
                rows = np.repeat(_times(offsets, idx, value, carried.value), np.diff(offsets), axis=0)
                order = np.argsort(idx, kind="stable")
                heads = np.flatnonzero(np.concatenate(([True], np.diff(idx[order]) != 0)))
                own = idx[order][heads]
                total[own] += np.add.reduceat((rows * value[:, None])[order], heads, axis=0)
                touched[own] = True
        at = np.flatnonzero(touched)
        for some in np.array_split(at, max(1, len(at) // 8192)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), *[pa.array(np.ascontiguousarray(total[some, j])) for j in range(k)]],
                ["idx", *[f"c{j}" for j in range(k)]])

    schema = "idx long, " + ", ".join(f"c{j} double" for j in range(k))
    sums = vectors.select("indices", "values").mapInArrow(run, schema).groupBy("idx").agg(
        *[F.sum(f"c{j}").alias(f"c{j}") for j in range(k)]).toArrow()
    out = np.zeros((width, k))
    out[sums.column("idx").to_numpy()] = np.column_stack([sums.column(f"c{j}").to_numpy() for j in range(k)])
    carried.destroy()
    return out


def leading_eigenvectors(times: Callable[[np.ndarray], np.ndarray], width: int, k: int, seed: int,
                         tol: float = 1e-10, passes: int = 200) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix that is only known by its
    products with blocks of vectors; the eigenvectors; their residuals ‖CV - VΛ‖.

    Block subspace iteration: each product widens an orthonormal basis by the part of it
    that the basis does not span; the matrix restricted to the basis gives the estimates.
    A full basis is cut back to its best vectors, so at most ``BASIS_BYTES`` are held."""
    block = min(width, k + OVERSAMPLE)
    most = max(3 * block, min(12 * block, BASIS_BYTES // (16 * width)))
    new = np.linalg.qr(np.random.RandomState(seed).randn(width, block))[0]
    basis, images = np.zeros((width, 0)), np.zeros((width, 0))
    for _ in range(passes):
        basis, images = np.hstack((basis, new)), np.hstack((images, times(new)))
        inner = basis.T @ images
        values, inside = np.linalg.eigh((inner + inner.T) / 2)
        order = np.argsort(-values, kind="stable")
        values, inside = values[order], inside[:, order]
        vectors = basis @ inside[:, :block]
        rest = images @ inside[:, :block] - vectors * values[:block]
        residuals = np.linalg.norm(rest[:, :k], axis=0)
        if residuals.max() <= tol * max(1.0, values[0]):
            break
        if basis.shape[1] + block > most:
            basis, images = vectors, images @ inside[:, :block]
        for _ in range(2):
            rest -= basis @ (basis.T @ rest)
        q, r = np.linalg.qr(rest)
        lasting = np.abs(np.diag(r)) > 1e-12 * max(1.0, values[0])
        new = q[:, lasting][:, :width - basis.shape[1]]
        if not new.shape[1]:
            break
        new = np.linalg.qr(new - basis @ (basis.T @ new))[0]
    vectors = vectors[:, :k]
    # a component's sign is free: the entry farthest from zero is positive
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)
    return values[:k], vectors, residuals


def project(vectors: DataFrame, matrix: np.ndarray, out: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``vectors(indices, values)`` and ``out``, the vector times
    ``matrix``, as an array."""
    carried = vectors.sparkSession.sparkContext.broadcast(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                rows = _times(*_sparse(part), carried.value)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), pa.array(rows.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns[2:], lists], [*keep, out])

    fields = vectors.select(*keep).schema.add(out, T.ArrayType(T.DoubleType()))
    return vectors.select("indices", "values", *keep).mapInArrow(run, fields)


def mixture_sums(points: DataFrame, weights, means, covariances, column: str = "features"):
    """The E step of a Gaussian mixture over ``points`` (an array column): per component
    the sum of its shares, of shares x points and of shares x outer products, and the
    log-likelihood.  A task hands on one row per sum."""
    weights, means = np.asarray(weights, float), np.asarray(means, float)
    k, d = means.shape
    roots = np.linalg.cholesky(np.asarray(covariances, float))
    inverse = np.linalg.inv(roots)
    constant = np.log(weights) - np.log(np.diagonal(roots, axis1=1, axis2=2)).sum(axis=1) - d / 2 * np.log(2 * np.pi)
    slots = 1 + d + d * d

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, likelihood = np.zeros((k, slots)), 0.0
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            away = np.stack([(x - means[j]) @ inverse[j].T for j in range(k)])
            logs = constant - 0.5 * (away * away).sum(axis=2).T
            top = logs.max(axis=1, keepdims=True)
            share = np.exp(logs - top)
            whole = share.sum(axis=1, keepdims=True)
            likelihood += float((top + np.log(whole)).sum())
            share /= whole
            for j in range(k):
                own = x * share[:, j:j + 1]
                total[j] += np.concatenate(([share[:, j].sum()], own.sum(axis=0), (own.T @ x).ravel()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(np.repeat(np.arange(k), slots), k)), pa.array(np.append(np.tile(np.arange(slots), k), 0)),
             pa.array(np.append(total.ravel(), likelihood))], ["component", "slot", "value"])

    sums = (points.select(column).mapInArrow(run, "component long, slot long, value double")
            .groupBy("component", "slot").agg(F.sum("value").alias("value")).collect())
    out, likelihood = np.zeros((k, slots)), 0.0
    for r in sums:
        if r.component == k:
            likelihood = r.value
        else:
            out[r.component, r.slot] = r.value
    return out[:, 0], out[:, 1:1 + d], out[:, 1 + d:].reshape(k, d, d), likelihood


def em_step(points: DataFrame, weights, means, covariances, column: str = "features"):
    """M9, one step of expectation and maximisation: new weights, means and covariances,
    and the log-likelihood of the old ones.  A component without any share keeps its place."""
    share, first, second, likelihood = mixture_sums(points, weights, means, covariances, column)
    means, covariances = np.array(means, float), np.array(covariances, float)
    for j in np.flatnonzero(share > 0):
        means[j] = first[j] / share[j]
        covariances[j] = second[j] / share[j] - np.outer(means[j], means[j])
    return share / share.sum(), means, covariances, likelihood
