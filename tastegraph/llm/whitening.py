"""Whitening of vectors along the leading principal components, found by spectrum slicing.

The covariance of the distinct vectors is gathered exactly: every task centres its integers by the whole number next to
the mean, multiplies, and sends one sum an entry; the rest of the centring is subtracted from whole numbers. Only this
matrix (dimension by dimension) reaches the driver.

By Sylvester's law a factorisation LDL' of ``V - s I`` has as many positive pivots as V has eigenvalues above s. Bisection
by such counts isolates each leading eigenvalue; Rayleigh quotient iteration then converges cubically to its vector; a
quotient that leaves its interval is sent back to bisection. Counts just below and above the value found certify its number.
Eigenvalues that no shift in double precision tells apart share a slice, and their vectors are made orthogonal.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tastegraph.llm.common import written
from tastegraph.llm.maxscore import scaled

#: Whole numbers up to here are exact in double precision.
EXACT = 1 << 53
#: Rows that are multiplied at once.
ROWS = 4_096


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are above ``shift``: positive pivots of LDL' with one-by-one and
    two-by-two pivots (a two-by-two pivot has one eigenvalue of either sign)."""
    m = matrix - shift * np.eye(len(matrix))
    enough, k, positive = (1 + 17 ** 0.5) / 8, 0, 0

    def swap(i: int, j: int) -> None:
        m[[i, j]] = m[[j, i]]
        m[:, [i, j]] = m[:, [j, i]]

    while k < len(m):
        column = np.abs(m[k + 1:, k])
        most = column.max(initial=0.0)
        if most == 0:
            positive += m[k, k] > 0
            k += 1
            continue
        r, size = k + 1 + int(column.argmax()), 1
        if abs(m[k, k]) < enough * most:
            row = np.abs(m[r, k:])
            row[r - k] = 0
            if abs(m[k, k]) * row.max() >= enough * most * most:
                pass
            elif abs(m[r, r]) >= enough * row.max():
                swap(k, r)
            else:
                swap(k + 1, r)
                size = 2
        below = m[k + size:, k:k + size]
        if size == 1:
            positive += m[k, k] > 0
            m[k + 1:, k + 1:] -= np.outer(below, below) / m[k, k]
        else:
            positive += 1
            m[k + 2:, k + 2:] -= below @ np.linalg.solve(m[k:k + 2, k:k + 2], below.T)
        k += size
    return int(positive)


def _iterate(matrix: np.ndarray, low: float, high: float, found: list[np.ndarray], tolerance: float) -> tuple[float, np.ndarray, float]:
    """(Rayleigh quotient, vector, residual) near the middle of a slice, orthogonal to what is found."""
    d = len(matrix)
    vector = np.random.default_rng(len(found)).standard_normal(d)
    shift, best = (low + high) / 2, (np.inf, 0.0, vector)
    for step in range(40):
        for other in found:
            vector = vector - (other @ vector) * other
        vector /= np.linalg.norm(vector)
        quotient = float(vector @ matrix @ vector)
        residual = float(np.linalg.norm(matrix @ vector - quotient * vector))
        if step and residual < best[0] and abs(quotient - (low + high) / 2) <= (high - low) / 2 + 64 * tolerance:
            best = (residual, quotient, vector)
        elif step > 3 and best[0] <= 64 * tolerance:
            break  # no better in this precision
        # first steps stay in the slice; then the shift follows the quotient
        shift = quotient if step >= 2 and low < quotient < high else shift
        try:
            vector = np.linalg.solve(matrix - shift * np.eye(d), vector)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            vector = np.linalg.solve(matrix - (shift + tolerance) * np.eye(d), vector)
    residual, quotient, vector = best
    return quotient, vector, residual


def leading(matrix: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as rows) of the largest eigenvalues of a symmetric matrix, falling.

    Raises ArithmeticError if the counts do not certify an eigenvalue's number.
    """
    matrix = np.asarray(matrix, float)
    d = len(matrix)
    reach = np.abs(matrix).sum(axis=1).max(initial=0.0)
    tolerance = max(d, 1) * np.finfo(float).eps * reach
    counts: dict[float, int] = {}

    def count(shift: float) -> int:
        if shift not in counts:
            counts[shift] = above(matrix, shift)
        return counts[shift]

    def certified(k: int, quotient: float, residual: float) -> bool:
        slack = max(16 * tolerance, 4 * residual)
        return count(quotient - slack) >= k > count(quotient + slack)

    values: list[float] = []
    vectors: list[np.ndarray] = []
    for k in range(1, min(components, d) + 1):
        if reach == 0:
            values.append(0.0)
            vectors.append(np.eye(d)[k - 1])
            continue
        low, high = -reach * 1.01 - tolerance, reach * 1.01 + tolerance
        counts[low], counts[high] = d, 0
        low = max(s for s in counts if counts[s] >= k)
        high = min(s for s in counts if s > low and counts[s] < k)
        while True:
            alone = count(low) == k and count(high) == k - 1
            if alone and high - low < 0.1 * reach:
                quotient, vector, residual = _iterate(matrix, low, high, [], tolerance)
                # counts within rounding of a multiple eigenvalue may look alone: then its vector may be an earlier one
                new = all(abs(v @ vector) < 1e-6 for v in vectors)
                if new and residual <= 64 * tolerance and certified(k, quotient, residual):
                    break
            if high - low <= 8 * tolerance:  # not to be told apart from its neighbours
                quotient, vector, residual = _iterate(matrix, low, high, [v for v, e in zip(vectors, values) if e - high <= 64 * tolerance], tolerance)
                break
            middle = (low + high) / 2
            low, high = (middle, high) if count(middle) >= k else (low, middle)
        if not certified(k, quotient, residual):
            raise ArithmeticError(f"eigenvalue {k} is not certified: {quotient} with residual {residual}")
        values.append(quotient)
        vectors.append(vector)
    return np.array(values), np.array(vectors).reshape(len(values), d)


@dataclass(frozen=True)
class Whitening:
    """What the fit list determines. ``spread`` tells which components have a variance beyond rounding."""

    n: int
    centre: list[int]  # whole numbers next to the mean
    rest: list[int]  # sums of x - centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def spread(self) -> np.ndarray:
        return self.values > len(self.centre) * 64 * np.finfo(float).eps * self.trace

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows; NaN along components without spread."""
        centred = (x - np.array(self.centre, x.dtype)).astype(float) - np.array(self.rest, float) / self.n
        scale = np.sqrt(np.where(self.spread, self.values, 1.0))
        out = centred @ (self.vectors / scale[:, None]).T
        out[:, ~self.spread] = np.nan
        return out

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n * x - S)^2, exact; None beyond 64 bits."""
        centred = x - np.array(self.centre, x.dtype)
        most = self.n * max(_most(centred), 1) + max(map(abs, self.rest), default=0)
        if most * most * max(x.shape[1], 1) >= 1 << 63:
            centred = centred.astype(object)
        z = self.n * centred - np.array(self.rest, centred.dtype)
        return [v if v < 1 << 63 else None for v in (z * z).sum(axis=1).tolist()]


def _most(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def _matrix(vectors: pa.Array, d: int) -> np.ndarray:
    """Rows of long, shorter vectors filled with zeros; of Python numbers where 64 bits might not hold differences."""
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), d), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out if _most(out) < 1 << 40 else out.astype(object)


def _products(y: np.ndarray) -> np.ndarray:
    """Sum of the outer products of the rows, exact."""
    most = _most(y)
    if most * most * len(y) < EXACT:
        f = y.astype(float)
        return (f.T @ f).astype(np.int64).astype(object)
    y = y.astype(object)
    return y.T @ y


def _totals(fit: DataFrame, d: int, function: Callable[[np.ndarray], np.ndarray], size: int) -> list[int]:
    """``size`` whole numbers: the sum of what ``function`` gives for all rows of ``fit``. One number an entry and task is sent."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, object)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                total = total + function(_matrix(batch.column(0).slice(at, ROWS), d))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([Decimal(int(v)) for v in total[used]], pa.decimal128(38, 0))], names=["at", "value"])

    parts = fit.select("x").mapInArrow(summed, "at int, value decimal(38,0)")
    out = [0] * size
    for at, value in parts.groupBy("at").agg(F.sum("value")).collect():
        out[at] = int(value)
    return out


def fit(vectors: DataFrame, components: int = 4) -> tuple[Whitening | None, DataFrame]:
    """(model, fit list) of rows (x array<long>): each distinct vector counts once. No model without vectors."""
    distinct = written(vectors.select("x").distinct(), "whitening")
    n, d = distinct.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("x")), F.lit(0))).first()
    if not n or not d:
        return None, distinct
    sums = _totals(distinct, d, lambda x: x.astype(object).sum(axis=0), d)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre, strict=True)]
    upper = np.triu_indices(d)
    held = _totals(distinct, d, lambda x: _products(x - np.array(centre, x.dtype))[upper], len(upper[0]))
    matrix = np.zeros((d, d))
    for i, j, total in zip(*upper, held, strict=True):
        matrix[i, j] = matrix[j, i] = float(Fraction(n * total - rest[i] * rest[j], n * n))
    values, found = leading(matrix, components)
    return Whitening(n, centre, rest, values, found, float(np.trace(matrix))), distinct


def identity_error(model: Whitening, distinct: DataFrame) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, measured on all its rows."""
    d, k = len(model.centre), int(model.spread.sum())
    if not k:
        return None

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k + 1))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                w = model.project(_matrix(batch.column(0).slice(at, ROWS), d))[:, model.spread]
                total += np.column_stack([w.T @ w, w.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], names=["at", "value"])

    out = np.zeros(k * (k + 1))
    for at, value in distinct.select("x").mapInArrow(summed, "at int, value double").groupBy("at").agg(F.sum("value")).collect():
        out[at] = value
    out = out.reshape(k, k + 1) / model.n
    return float(np.abs(out[:, :k] - np.outer(out[:, k], out[:, k]) - np.eye(k)).max())


def whitened(rows: DataFrame, scale: float = 256.0, components: int = 4, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each usable row and component.

    A vector takes part if it is not null and all its entries are finite; its entries c become floor(scale * c). Vectors
    shorter than the longest one count as ending in zeros; components beyond the dimension do not exist, so an empty table
    and one of empty vectors give no rows. Repeated rows are all returned and count once in the fit. Along a component
    without variance (one distinct vector, or fewer independent ones than components) ``whitened`` is null; ``explained``
    is null if there is no variance at all, ``deviation`` if it exceeds 64 bits. Sums of products must fit in 38 digits.
    """
    usable = rows.select(F.col(f"`{key}`").alias("vec_id"), scaled(F.col(f"`{vector}`"), scale).alias("x")).where("x is not null")
    model, distinct = fit(usable, components)
    added = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    schema = StructType([usable.schema["vec_id"], *StructType.fromDDL(added)])
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    error, k = identity_error(model, distinct), len(model.values)
    explained = (model.values / model.trace).tolist() if model.trace > 0 else [None] * k

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), len(model.centre))
            size = batch.num_rows
            if not size:
                continue
            w = model.project(x).ravel()
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(size), k))),
                pa.array(np.tile(np.arange(1, k + 1), size), pa.int32()), pa.array(np.full(size * k, model.n), pa.int64()),
                pa.array(model.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(size), k))),
                pa.array(w, mask=np.isnan(w)), pa.array(explained * size, pa.float64()), pa.array([error] * (size * k), pa.float64()),
            ], names=schema.names)

    return usable.mapInArrow(project, schema)
