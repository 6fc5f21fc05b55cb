"""Whitening of embeddings by spectral divide and conquer with QDWH polar decompositions.

A component ``c`` of a vector stands for the integer ``floor(1024 * c) + 100000``. Two passes over the vectors make the model: the sums of every
dimension, which are exact, and the covariance of the centred integers. Each task adds up its own vectors in numpy, and Spark adds up what the
tasks send: one row per dimension, or per pair of dimensions. Only these sums, whose number depends on the width of the vectors alone, come to
the driver; more than ``WIDTH`` dimensions are refused.

The eigenvectors come from the covariance without an eigenvalue routine. The mean eigenvalue (the trace by the width) is a shift that has
eigenvalues on both sides. The orthogonal polar factor of the shifted matrix, found by the dynamically weighted Halley iteration (QDWH), has the
eigenvalues +1 and -1 on the same vectors; half of its sum with the identity projects on the invariant subspace above the shift. Bases of
that subspace and of its complement turn the problem into two smaller ones, which are split in turn, down to single vectors or to subspaces
whose eigenvalues are all equal. The upper part comes first, so splitting ends with the components that are asked for. They and the
means, which are as bounded, go to all tasks, which project and scale their vectors.

Defined results: vectors that are null or hold a null or non-finite component are left out; shorter vectors than the longest one count as if they
ended in zeros; vectors without components are no error. Every remaining row counts, repeated ones too, and is returned, null ids included. A component
without variance has null as its whitened value. Any orthonormal basis serves for components of equal variance. An empty table, or one of
vectors of width 0, gives no rows. Components beyond the range of the integers fail. Other columns are carried along in ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.session import staged

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
WIDTH = 4096
EPS = np.finfo(float).eps
LARGEST = 2**62


# Polar decomposition and the spectrum


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QDWH. Where ``a`` has the eigenvalue 0, so has the result."""
    n = len(a)
    one = np.eye(n)
    x = a / np.abs(a).sum(axis=0).max()  # the sum norm bounds the singular values by 1
    # A lower bound of them: too low a bound costs iterations, never precision.
    r = np.linalg.qr(x, mode="r")
    inverse = np.linalg.inv(r) if np.abs(np.diag(r)).min() > EPS else None
    low = 1.0 / np.sqrt((inverse**2).sum()) if inverse is not None else EPS
    low = min(max(low, EPS), 1.0)
    for _ in range(40):
        d = np.cbrt(4 * (1 - low**2) / low**4)
        weight_a = np.sqrt(1 + d) + np.sqrt(8 - 4 * d + 8 * (2 - low**2) / (low**2 * np.sqrt(1 + d))) / 2
        weight_b = (weight_a - 1) ** 2 / 4
        weight_c = weight_a + weight_b - 1
        ratio = weight_b / weight_c
        if weight_c > 100:
            q = np.linalg.qr(np.concatenate([np.sqrt(weight_c) * x, one]))[0]
            new = ratio * x + (weight_a - ratio) / np.sqrt(weight_c) * (q[:n] @ q[n:].T)
        else:
            new = ratio * x + (weight_a - ratio) * np.linalg.solve(one + weight_c * (x.T @ x), x.T).T
        new = (new + new.T) / 2
        low = min(low * (weight_a + weight_b * low**2) / (1 + weight_c * low**2), 1.0)
        moved = np.linalg.norm(new - x)
        x = new
        if abs(1 - low) < 10 * EPS and moved <= np.cbrt(EPS) * np.linalg.norm(x):
            break
    return x


def halves(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below the mean eigenvalue, or None if all eigenvalues are equal."""
    n = len(a)
    mean = np.trace(a) / n
    spread = np.linalg.norm(a - mean * np.eye(n)) / np.sqrt(n)  # the deviation of the eigenvalues
    for nudge in (0.0, 0.013, -0.013, 0.029, -0.029, 0.053, -0.053):  # an eigenvalue may be the shift itself
        sign = polar_factor(a - (mean + nudge * spread) * np.eye(n))
        projector = (sign + np.eye(n)) / 2
        k = round(float(np.trace(projector)))
        if 0 < k < n and np.linalg.norm(projector @ projector - projector) <= 1e-8:
            break
    else:
        return None
    basis = np.linalg.qr(projector @ np.random.default_rng(n).normal(size=(n, k)))[0]
    for _ in range(2):
        basis = np.linalg.qr(projector @ basis)[0]
    whole = np.linalg.qr(basis, mode="complete")[0]
    return whole[:, :k], whole[:, k:]


def spectrum(a: np.ndarray) -> Iterator[tuple[float, np.ndarray]]:
    """Eigenvalues and unit eigenvectors of a symmetric matrix, by falling eigenvalue, as they are asked for."""
    scale = np.linalg.norm(a)

    def split(basis: np.ndarray) -> Iterator[np.ndarray]:
        inner = basis.T @ a @ basis
        inner = (inner + inner.T) / 2
        n = len(inner)
        spread = np.linalg.norm(inner - np.trace(inner) / n * np.eye(n))
        parts = halves(inner) if n > 1 and spread > 4 * EPS * scale else None
        if parts is None:
            yield from basis.T
            return
        for part in parts:
            yield from split(np.linalg.qr(basis @ part)[0])

    for vector in split(np.eye(len(a))):
        # The same sign in every run: the entry of largest size is positive.
        vector = vector * (1.0 if vector[np.argmax(np.abs(vector))] >= 0 else -1.0)
        yield float(vector @ a @ vector), vector


# Sums over all vectors


@dataclass(frozen=True)
class Whitening:
    """The model: number of vectors, sums of the integers by dimension, and the components with their variances."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def _whole(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The places of the vectors that take part, and ``floor(1024 * c)`` of their components, filled up with zeros."""
    lists = batch.column("vector")
    if not len(lists):
        return np.zeros(0, dtype=np.int64), np.zeros((0, 0), dtype=np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null components are not a number
    lengths = np.array([-1 if n is None else n for n in pc.list_value_length(lists).to_pylist()])
    ends = np.cumsum(np.maximum(lengths, 0))
    bad = np.append(0, np.cumsum(~np.isfinite(values)))
    good = np.flatnonzero((lengths >= 0) & (bad[ends] == bad[ends - np.maximum(lengths, 0)]))
    width = int(lengths[good].max()) if len(good) else 0
    places = np.arange(width)
    inside = places < lengths[good][:, None]
    at = (ends - np.maximum(lengths, 0))[good][:, None] + places
    x = np.zeros((len(good), width))
    x[inside] = np.floor(SCALE * values[at[inside]])
    if np.abs(x).max(initial=0) >= LARGEST:
        raise OverflowError("a component is beyond the range of the integers")
    return good, x.astype(np.int64)


def _wider(a: np.ndarray, width: int) -> np.ndarray:
    return np.pad(a, [(0, 0)] * (a.ndim - 1) + [(0, width - a.shape[-1])])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, sums, size = 0, np.zeros(0, dtype=np.int64), np.zeros(0)
    for batch in batches:
        good, x = _whole(batch)
        width = max(len(sums), x.shape[1])
        sums, size = _wider(sums, width), _wider(size, width)
        size += _wider(np.abs(x).sum(axis=0, dtype=np.float64), width)
        if size.max(initial=0) >= LARGEST:
            raise OverflowError("the sum of a dimension is beyond the range of the integers")
        sums += _wider(x.sum(axis=0), width)
        n += len(good)
    dims = pa.array(np.arange(-1, len(sums)), pa.int32())
    yield pa.RecordBatch.from_arrays([dims, pa.array(np.append(n, sums), pa.int64())], ["dim", "total"])


def _centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    """``n * integer - sum`` by dimension, exact."""
    if model.n * (float(np.abs(x).max(initial=0)) + OFFSET) + float(np.abs(model.sums).max(initial=0)) >= LARGEST:
        raise OverflowError("the deviations are beyond the range of the integers")
    return model.n * (_wider(x, len(model.sums)) + OFFSET) - model.sums


def _products(model: Whitening):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(model.sums)
        total = np.zeros((width, width))
        for batch in batches:
            y = _centred(_whole(batch)[1], model) / model.n
            total += y.T @ y
        i, j = np.triu_indices(width)
        columns = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "total"])

    return run


def fit(embeddings: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The model of all vectors of the column ``embedding``."""
    vectors = embeddings.select(F.col("embedding").alias("vector"))
    summed = vectors.mapInArrow(_sums, "dim int, total long").groupBy("dim").agg(F.sum("total").alias("total")).toArrow()
    totals = dict(zip(summed["dim"].to_pylist(), summed["total"].to_pylist()))
    n, width = totals.pop(-1, 0), len(totals)
    if width > WIDTH:
        raise ValueError(f"vectors of {width} components; at most {WIDTH} are whitened")
    sums = np.array([totals[d] + n * OFFSET for d in range(width)], dtype=np.int64)
    model = Whitening(n, sums, np.zeros(0), np.zeros((0, width)), 0.0)
    if not n or not width:
        return model
    products = vectors.mapInArrow(_products(model), "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).toArrow()
    covariance = np.zeros((width, width))
    i, j = products["i"].to_numpy(), products["j"].to_numpy()
    covariance[i, j] = covariance[j, i] = products["total"].to_numpy() / n
    found = [pair for pair, _ in zip(spectrum(covariance), range(components))]
    return Whitening(n, sums, np.array([e for e, _ in found]), np.array([v for _, v in found]), float(np.trace(covariance)))


# The whitened vectors


def _squares(y: np.ndarray) -> pa.Array:
    """The sum of the squares of each row, exact."""
    exact = pa.decimal128(38, 0)
    if (y.astype(np.float64) ** 2).sum(axis=1).max(initial=0) < LARGEST:
        return pa.array((y * y).sum(axis=1)).cast(pa.decimal128(19, 0)).cast(exact)
    return pa.array([Decimal(sum(v * v for v in row)) for row in y.tolist()], exact)


def _project(model: Whitening):
    some = model.values > len(model.sums) * EPS * model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scaled = model.vectors[some].T / np.sqrt(model.values[some])
        for batch in batches:
            good, x = _whole(batch)
            y = _centred(x, model)
            values = np.full((len(good), len(some)), np.nan)
            values[:, some] = (y / model.n) @ scaled
            flat = pa.array(values.ravel(), mask=np.tile(~some, len(good)))
            whitened = pa.ListArray.from_arrays(pa.array(np.arange(len(good) + 1) * len(some), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(good)), _squares(y), whitened], ["row", "deviation", "whitened"])

    return run


def whiten(embeddings: DataFrame, model: Whitening) -> DataFrame:
    """``(row, deviation, whitened)`` for every vector that takes part.

    ``deviation`` is the sum over the dimensions of ``(n * integer - sum)`` squared, a decimal without digits lost; ``whitened`` has one value per component.
    """
    rows = embeddings.select(F.struct("*").alias("row"), F.col("embedding").alias("vector"))
    if not len(model.values):
        rows = rows.limit(0)
    return rows.mapInArrow(_project(model), f"row {embeddings.schema.simpleString()}, deviation decimal(38,0), whitened array<double>")


def identity_error(whitened: DataFrame, model: Whitening) -> Column:
    """The largest entry, by size, of the covariance of ``whitened`` minus the identity: a scalar. Components without variance are left out."""
    value = lambda i: F.get("whitened", F.lit(i))
    some = np.flatnonzero(model.values > len(model.sums) * EPS * model.trace).tolist()
    errors = [F.abs(F.covar_pop(value(i), value(j)) - (1.0 if i == j else 0.0)) for i in some for j in some if j <= i]
    return whitened.agg(F.array_max(F.array(*errors) if errors else F.array(F.lit(None).cast("double"))).alias("error")).scalar()


def components(embeddings: DataFrame, count: int = COMPONENTS) -> DataFrame:
    """``(row, component, n, deviation, whitened, explained, identity_error)``: a row for each vector and component."""
    model = fit(embeddings, count)
    found = staged(whiten(embeddings, model), "whitened")
    shares = F.array(*[F.lit(float(e / model.trace) if model.trace else None).cast("double") for e in model.values])
    each = found.withColumn("error", identity_error(found, model)).select("row", "deviation", "error", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "row", (F.col("place") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("place")).alias("explained"), F.col("error").alias("identity_error"),
    )
