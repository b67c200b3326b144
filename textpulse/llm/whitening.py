"""Embedding whitening with components from contour integrals (FEAST).

The covariance is summed by Spark tasks. Its leading eigenvectors come from the FEAST
projector: a quadrature of the resolvent over a circle round an eigenvalue interval, applied to
a block of vectors, then a Rayleigh-Ritz step. Inertia counts of shifted covariances place the
interval and prove that no component in it is missing.

Defined results:

* A row whose vector is null or has a null, NaN or infinite entry is dropped.
* Vectors may differ in length: absent entries count as zero, so an empty vector is all zero.
* Equal vectors count once in every statistic; every remaining row is projected, repeats too.
* A component whose eigenvalue is numerically zero cannot be whitened and is not returned: a
  table with one distinct vector, or none, gives no rows. Null ids stay null.
* Tied eigenvalues: some orthonormal basis of their space, the same for all rows.
* A ``deviation`` beyond 64 bits is null. Entries beyond 64 bits count as the nearest long.
* More than ``MAX_DIMENSIONS`` entries in a vector are an error.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from textpulse.llm.common import ready_workers, store

#: The covariance, dimensions x dimensions doubles, is the only thing that grows in the driver.
MAX_DIMENSIONS = 4096
SCALE = 256
POINTS = 8  # quadrature nodes on the upper half circle
ROUNDS = 30
GAIN, MOST_POINTS = 100, 64  # by what a round must lessen the residuals; nodes at most
BLOCK_ROWS = 4096
#: Eigenvalues below this share of the largest, times the dimensions, are numerically zero.
ZERO = 4 * np.finfo(float).eps
_EXACT = 1 << 62


@dataclass(frozen=True)
class Whitening:
    """What projects a vector: counts and sums of the fit list, components by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray  # eigenvalues
    vectors: np.ndarray  # dimensions x components, unit columns
    trace: float


# Vectors as whole numbers


def usable(vector: str) -> Column:
    """Vectors that are there and have finite entries only."""
    finite = F.forall(vector, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf")))
    return F.col(vector).isNotNull() & finite


def quantised(vector: str) -> Column:
    return F.transform(vector, lambda e: F.floor(SCALE * e.cast("double")).cast("long"))


def _packed(x: np.ndarray) -> bytes:
    """A width and the entries up to the last that is not zero: equal vectors, equal bytes."""
    x = x[: np.flatnonzero(x)[-1] + 1] if x.any() else x[:0]
    for kind in ("<i2", "<i4"):
        if len(x) == 0 or (np.iinfo(kind).min <= x.min() and x.max() <= np.iinfo(kind).max):
            return kind[2:].encode() + x.astype(kind).tobytes()
    return b"8" + x.astype("<i8").tobytes()


def _block(packed: list[bytes], dimensions: int) -> np.ndarray:
    """Packed vectors as rows; those of one width and length are read at one go."""
    rows = np.zeros((len(packed), dimensions), np.int64)
    alike = defaultdict(list)
    for i, p in enumerate(packed):
        alike[p[:1], len(p)].append(i)
    for (width, size), at in alike.items():
        joined = b"".join(packed[i][1:] for i in at)
        x = np.frombuffer(joined, f"<i{width.decode()}").reshape(len(at), -1) if joined else np.zeros((len(at), 0))
        rows[at, : x.shape[1]] = x
    return rows


def _rows(column: pa.ListArray, dimensions: int | None = None) -> np.ndarray:
    """A column of vectors as rows, padded with zeros or cut to ``dimensions``."""
    values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
    sizes = np.diff(offsets)
    dimensions = int(sizes.max(initial=0)) if dimensions is None else dimensions
    rows = np.zeros((len(sizes), dimensions), np.int64)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        kept = min(int(size), dimensions)
        rows[at, :kept] = values[offsets[at][:, None] + np.arange(kept)]
    return rows


def fit_list(rows: DataFrame, vector: str) -> DataFrame:
    """``x``: each distinct quantised vector once, packed, stored. Repeats meet before the shuffle."""

    def run(batches):
        for batch in batches:
            column = batch.column(0)
            values, offsets = column.values.to_numpy(), column.offsets.to_numpy().tolist()
            made = [_packed(values[i:j]) for i, j in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_pydict({"x": pa.array(made, pa.binary())})

    x = rows.filter(usable(vector)).select(quantised(vector).alias("x"))
    return store(x.mapInArrow(run, "x binary").distinct(), "vectors")


# Sums over the fit list: every task adds up its rows, one row per entry meets in the shuffle


def _column_sums(stored: DataFrame) -> list[int]:
    def run(batches):
        totals: list[int] = []
        for batch in batches:
            packed = batch.column(0).to_pylist()
            for at in range(0, len(packed), BLOCK_ROWS):
                part = packed[at : at + BLOCK_ROWS]
                x = _block(part, max((len(p) - 1) // int(p[:1]) for p in part))
                wide = np.abs(x.astype(np.float64)).max(initial=0) * len(x) >= _EXACT
                made = x.astype(object).sum(axis=0) if wide else x.sum(axis=0)
                totals.extend([0] * (len(made) - len(totals)))
                for i, v in enumerate(made.tolist()):
                    totals[i] += v
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(len(totals)), pa.int32()), "s": pa.array(map(str, totals), pa.string())})

    parts = stored.mapInArrow(run, "i int, s string")
    made = parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).filter(f"i < {MAX_DIMENSIONS + 1}")
    sums = {r["i"]: int(r["s"]) for r in made.collect()}  # one row per dimension
    if len(sums) > MAX_DIMENSIONS:
        raise ValueError(f"vectors of more than {MAX_DIMENSIONS} entries")
    return [sums[i] for i in range(len(sums))]


def _sum_products(stored: DataFrame, dimensions: int, width: int, start) -> np.ndarray:
    """Sum of y y' over the fit list; ``start()`` gives a map from packed vectors to rows y.

    Only the upper triangle travels, one row per entry and task.
    """
    upper = np.triu_indices(width)

    def run(batches):
        rows_of, total = start(), np.zeros((width, width))
        for batch in batches:
            packed = batch.column(0).to_pylist()
            for at in range(0, len(packed), BLOCK_ROWS):
                y = rows_of(_block(packed[at : at + BLOCK_ROWS], dimensions))
                total += y.T @ y
        entries = total[upper]
        for at in range(0, len(entries), 1 << 16):
            part = entries[at : at + (1 << 16)]
            yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(at, at + len(part)), pa.int64()), "s": pa.array(part)})

    made = stored.mapInArrow(run, "i long, s double").groupBy("i").agg(F.sum("s").alias("s"))
    found = made.toArrow()  # width x (width + 1) / 2 rows, bounded by MAX_DIMENSIONS
    total = np.zeros((width, width))
    entries = np.zeros(len(upper[0]))
    entries[found.column("i").to_numpy()] = found.column("s").to_numpy()
    total[upper] = entries
    return total + np.triu(total, 1).T


def covariance(stored: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Covariance of the fit list, divisor n.

    Vectors are centred on the whole number next to their mean before they are multiplied, so
    sums are sums of whole numbers: exact below 2^53, whatever the order. The rest of the mean
    is within a half and is taken off at the end.
    """
    centre = [round(Fraction(s, n)) for s in sums]
    near = np.array(centre, np.float64)
    rest = np.array([float(Fraction(s, n) - c) for s, c in zip(sums, centre)])
    total = _sum_products(stored, len(sums), len(sums), lambda: lambda x: x - near)
    return total / n - np.outer(rest, rest)


# Components


def count_above(a: np.ndarray, shift: float) -> int:
    """Eigenvalues of the symmetric ``a`` above ``shift``: the positive part of the inertia of
    ``a - shift`` from an LDL' factorisation with pivots of size one and two (Sylvester's law)."""
    m = a - shift * np.eye(len(a))
    least = np.finfo(float).tiny / np.finfo(float).eps
    alpha = (1 + 17**0.5) / 8
    positive, k, size = 0, 0, len(m)
    while k < size:
        w = m[k:, k:]
        step, column = 1, np.abs(w[1:, 0])
        if len(column) and column.max() > least and abs(w[0, 0]) < alpha * column.max():
            r = 1 + int(column.argmax())
            beside = np.abs(w[r])
            beside[r] = 0
            if abs(w[0, 0]) * (beside.max() / column.max()) < alpha * column.max():
                if abs(w[r, r]) >= alpha * beside.max():
                    w[[0, r]] = w[[r, 0]]
                    w[:, [0, r]] = w[:, [r, 0]]
                else:
                    w[[1, r]] = w[[r, 1]]
                    w[:, [1, r]] = w[:, [r, 1]]
                    step = 2
        if step == 1:
            pivot = w[0, 0]
            positive += pivot > 0
            if abs(pivot) > least:
                w[1:, 1:] -= np.outer(w[1:, 0], w[1:, 0]) / pivot  # stays symmetric to the last bit
        else:  # a pivot block of size two is chosen only where its determinant is negative
            positive += 1
            taken = w[2:, :2] @ np.linalg.solve(w[:2, :2], w[2:, :2].T)
            w[2:, 2:] -= (taken + taken.T) / 2
        k += step
    return int(positive)


def interval(a: np.ndarray, wanted: int) -> tuple[float, float, int]:
    """(low, high, count): an interval that holds the ``wanted`` largest eigenvalues and few more.

    Both ends are placed by halving, on inertia counts alone. Where eigenvalues tie too closely to
    be told apart the interval takes all of them.
    """
    top = float(np.abs(a).sum(axis=1).max())
    width = len(a) * np.finfo(float).eps * top * 8
    low, above = -width, top + width
    over = len(a)  # eigenvalues above low
    left = low
    right = above
    while over > wanted + 1 and right - left > width:
        middle = (left + right) / 2
        if (found := count_above(a, middle)) >= wanted:
            left = low = middle
            over = found
        else:
            right = middle
    while over > wanted + 1 and low > -width:  # a tie: go below all of it
        low -= 8 * width
        if count_above(a, low) == over:
            break
        over = count_above(a, low)
    left, right = low, above
    while right - left > (top - low) / 64 + width:
        middle = (left + right) / 2
        if count_above(a, middle):
            left = middle
        else:
            right = middle
    return low, right, over


def components(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors) of the ``wanted`` largest eigenvalues of ``a``.

    Each round filters a block of vectors by the contour integral over the interval and replaces it
    by its Ritz vectors. It ends when the Ritz values inside are as many as the inertia counts say
    and their residuals are at rounding level; otherwise it is an error. Where eigenvalues outside
    stand close to the interval, a round that gains little doubles the nodes, which makes the filter
    steeper, and the spare vectors of the block.
    """
    size = len(a)
    low, high, count = interval(a, min(wanted, size))
    centre, radius = (high + low) / 2, (high - low) / 2
    points, before = POINTS, np.inf
    scale = max(abs(high), abs(low))
    enough = 16 * size * np.finfo(float).eps * scale
    random = np.random.default_rng(1)
    block = random.standard_normal((size, min(size, count + max(4, count // 2))))
    for _ in range(ROUNDS):
        nodes, weights = np.polynomial.legendre.leggauss(points)
        turns = np.exp(1j * np.pi * (nodes + 1) / 2)
        filtered = np.zeros_like(block)
        for turn, weight in zip(turns, weights):
            shifted = (centre + radius * turn) * np.eye(size) - a
            filtered += weight / 2 * np.real(radius * turn * np.linalg.solve(shifted, block.astype(complex)))
        basis, _ = np.linalg.qr(filtered)
        basis, _ = np.linalg.qr(basis)
        values, turned = np.linalg.eigh(basis.T @ a @ basis)
        block = basis @ turned
        residual = np.linalg.norm(a @ block - block * values, axis=0)
        good = (values > low) & (residual <= enough)
        if good.sum() == count == (values > low).sum():
            break
        worst = np.sort(residual[values > low])[:count].max(initial=0) if (values > low).sum() >= count else np.inf
        if not worst < before / GAIN:
            points = min(2 * points, MOST_POINTS)
            spare = min(size - block.shape[1], max(1, block.shape[1] - count))
            block = np.hstack([block, random.standard_normal((size, spare))])
        before = worst
    else:
        raise ArithmeticError(f"{int(good.sum())} of {count} components converged")
    best = np.flatnonzero(good)[::-1][:wanted]
    vectors = block[:, best]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(best))])
    return values[best], vectors * signs


def fit(rows: DataFrame, vector: str = "embedding", wanted: int = 4) -> tuple[Whitening | None, DataFrame]:
    """(whitening, its stored fit list); no whitening where no component has a spread."""
    ready_workers(rows.sparkSession)
    stored = fit_list(rows, vector)
    n = stored.count()
    sums = _column_sums(stored)
    if n < 2 or not sums:
        return None, stored
    a = covariance(stored, n, sums)
    trace = float(np.trace(a))
    if not trace > 0:
        return None, stored
    values, vectors = components(a, wanted)
    keep = values > ZERO * len(a) * max(values[0], 0)
    if not keep.any():
        return None, stored
    return Whitening(n, tuple(sums), values[keep], vectors[:, keep], trace), stored


def _projector(model: Whitening):
    """Packed rows to whitened ones."""
    centre = [round(Fraction(s, model.n)) for s in model.sums]
    near = np.array(centre, np.int64) if all(abs(c) < _EXACT for c in centre) else np.array(centre, np.float64)
    rest = np.array([float(Fraction(s, model.n) - c) for s, c in zip(model.sums, centre)])
    axes = model.vectors / np.sqrt(model.values)
    return lambda x: ((x.astype(np.float64) - near) - rest) @ axes


def identity_error(stored: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of (covariance of the whitened fit list - identity)."""
    width = len(model.values)
    total = _sum_products(stored, len(model.sums), width, lambda: _projector(model))
    return float(np.abs(total / model.n - np.eye(width)).max())


def _deviations(x: np.ndarray, model: Whitening) -> list[int | None]:
    """Sums of (n x - S)^2 in whole numbers."""
    most = model.n * (int(np.abs(x.astype(np.float64)).max(initial=0)) + 1) + max(map(abs, model.sums))
    if most**2 * max(1, x.shape[1]) < _EXACT:
        return ((model.n * x - np.array(model.sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((model.n * v - s) ** 2 for v, s in zip(row, model.sums)) for row in x.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


def whiten(rows: DataFrame, vector: str = "embedding", wanted: int = 4) -> DataFrame:
    """The usable rows with one more column, named ``whitening``: an array with, for each
    component, ``component, n, deviation, whitened, explained, identity_error``.

    A column of that name is replaced; all others pass through.
    """
    model, stored = fit(rows, vector, wanted)
    kind = "array<struct<component:int,n:long,deviation:long,whitened:double,explained:double,identity_error:double>>"
    kept = rows.drop("whitening") if vector != "whitening" else rows
    kept = kept.filter(usable(vector))
    if model is None:
        return kept.withColumn("whitening", F.array().cast(kind))
    error = identity_error(stored, model)
    dimensions = len(model.sums)
    names = [c for c in (f"x{k}" for k in range(len(kept.columns) + 3)) if c not in kept.columns]
    x, white, deviation = names[:3]
    sent = kept.withColumn(x, quantised(vector))
    columns = sent.columns
    made = StructType([*sent.schema.fields, *StructType.fromDDL(f"{white} array<double>, {deviation} long").fields])
    plain = StructType([StructField(f"c{k}", f.dataType) for k, f in enumerate(made.fields)])

    def run(batches):
        project = _projector(model)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                rows = _rows(pa.concat_arrays([part.column(columns.index(x))]), dimensions)
                found = project(rows)
                ends = np.arange(len(rows) + 1, dtype=np.int32) * found.shape[1]
                arrays = [pa.ListArray.from_arrays(ends, found.ravel()), pa.array(_deviations(rows, model), pa.int64())]
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], names=plain.names)

    explained = F.array(*(F.lit(e) for e in (model.values / model.trace).tolist()))
    entry = lambda w, k: F.struct(
        (k + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), F.col(deviation).alias("deviation"),
        w.alias("whitened"), F.element_at(explained, k + 1).alias("explained"), F.lit(error).alias("identity_error"),
    )
    found = sent.mapInArrow(run, plain).toDF(*made.names)
    return found.withColumn("whitening", F.transform(white, entry)).drop(*names[:3])
